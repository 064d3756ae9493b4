"""Slots in the windows of benchmark items, and passages."""

from menulake.llm.decontaminate import contaminated


def held(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    i = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(d, i).collect()}


def test_windows_with_many_slots(spark):
    items = ["sum: 3 5 7 9 11 13 17 19 23", "Anna Otto Emma Lisa ran home late with Klaus Maria Peter Eva"]
    docs = ["and sum: 3 5 7 9 11 13 17 19 23 is it", "and sum: 3 5 7 8 11 13 16 19 23 is it", "See. " + items[1], "so Max Paul ran home late with Ida Udo again"]
    got = held(spark, docs, items)
    assert set(got) == {(0, 0), (2, 1)} and all(r.n_found == r.n_windows and r.same_values for r in got.values())
    assert got[2, 1].n_windows == 8


LONG = "they walk to the market where Otto sells apples and there is a well from which all the people of the old town draw their water every morning before they go on to work, says Otto"


def test_one_slot_mistyped_in_a_long_copy(spark):
    got = held(spark, [LONG.replace("says Otto", "says Klaus"), "so we saw that there is a well from which all"], [LONG])
    assert set(got) == {(0, 0)} and got[0, 0].n_found < got[0, 0].n_windows


def test_passages_are_in_one_place(spark):
    w = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    stray = " ".join(" ".join(w[k:k + 5]) + " " + "x " * 40 for k in range(50, 0, -5))
    near = " ".join([*w[:8], "put", "in", *w[8:18]])
    assert set(held(spark, [stray, near], [" ".join(w)])) == {(1, 0)}


def test_slots_agree_over_alignments(spark):
    parts = ["as Otto came down the hill we all", "were glad that Otto came back home so", "early and told us what Otto saw there"]
    got = held(spark, [" x ".join(parts), " x ".join(p.replace("Otto", n) for p, n in zip(parts, ("Karl", "Paul", "Hans")))], [" ".join(parts)])
    assert set(got) == {(0, 0)}
