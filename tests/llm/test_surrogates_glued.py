"""Personal data right behind letters, and the dotted, spaced and IPv6 forms."""

import re

from menulake.llm.surrogates import replace_personal_data

# before, entity, behind
GLUED = [("ip", "10.20.30.40", ""), ("Tel", "555-123-4567", ""), ("SSN", "123-45-6789", ""), ("地址", "10.20.30.41", ""), ("电话", "555-123-4568", "。"), ("番号は", "123-45-6780", "です"), ("電話", "555.123.4560", "まで"), ("Tel", "555 123 4561", "")]
FORMS = [("call ", "555.123.4562", "."), ("call ", "555 123 4563", ", or"), ("", "fe80::1ff:fe23:4567:890a", ""), ("(", "2001:db8:85a3::8a2e:370:7334", ")"), ("", "2001:0db8:85a3:0000:0000:8a2e:0370:7335", ": no"),
         ("地址", "2001:db8::1", "的"), ("ip", "2001:DB8::2", ""), ("::ffff:", "10.20.30.42", "")]
CLEAN = ["a 12:30:45 b", "std::vector face::add", "x[1::2] y[::2]", "v 1.2.3 and 12.345.678", "00:1a:2b:3c:4d:5e", "n 1 234 567 890", "4.555.123.4567"]


def test_glued_and_other_forms(spark):
    cases = GLUED + FORMS + [(x, "", "") for x in CLEAN]
    df = spark.createDataFrame([(i, "".join(c)) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in replace_personal_data(df, "k").collect()}
    for i, (before, entity, behind) in enumerate(cases):
        new = got[i].text
        assert got[i].n_replaced == bool(entity) and new.startswith(before) and new.endswith(behind), new
        assert len(new) == len(before + entity + behind) and (not entity or entity not in new), new


def test_forms_of_one_number_agree(spark):
    r = replace_personal_data(spark.createDataFrame([(1, "555-123-4567 555.123.4567 (555) 123-4567; 555 123 4567; 2001:db8::9 2001:DB8::9")], "doc_id long, text string"), "k").first()
    a, b, c, d, e, f = re.fullmatch(r"(\S+) (\S+) (\(.{13}); (.{12}); (\S+) (\S+)", r.text).groups()
    assert r.n_replaced == 6 and len({re.sub("[^0-9]", "", x) for x in (a, b, c, d)}) == 1 and e == f.lower() != "2001:db8::9"
