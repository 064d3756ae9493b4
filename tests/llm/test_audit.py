"""The audit of near vectors, beside a hot group."""

import numpy as np
import pandas as pd

from menulake.llm import near_vectors as nv


def test_lost_links_beside_a_hot_group(spark, monkeypatch):
    # a graph that loses all links; those within the hot group come from its ball
    monkeypatch.setattr(nv, "CENTRES", 4)
    monkeypatch.setattr(nv, "SHARD", 100)
    monkeypatch.setattr(nv, "_search", lambda near, beam: lambda pdf: pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)}))
    rng = np.random.default_rng(4)
    hot = rng.normal(size=16) + rng.normal(size=(300, 16)) * 0.001
    some = rng.normal(size=(60, 16))
    some /= np.linalg.norm(some, axis=1)[:, None]
    side = rng.normal(size=(60, 16))
    side -= (side * some).sum(1)[:, None] * some
    side /= np.linalg.norm(side, axis=1)[:, None]
    x = np.concatenate([hot, some, some * np.cos(0.4) + side * np.sin(0.4)])  # a link is up to 0.451, a ball half of that
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = nv.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    want = ((x @ x.T) >= nv.NEAR).sum(1) - 1
    assert min(want[300:]) >= 1 and {r.vec_id: r.n_links for r in got} == dict(enumerate(want.tolist()))
    assert all(r.audit_recall == 1.0 for r in got)
