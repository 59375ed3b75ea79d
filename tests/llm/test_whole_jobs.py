"""What the operators must not lose, each against the case that was once lost."""

import re

import numpy as np
import pytest

from vellumgrid.llm import fingerprints, near_dedup, quality, toxicity


def test_near_pairs_below_a_looser_smallest_id(spark):
    """Smaller ids are variants at some 0.7 of B and C, which are near copies of each other."""
    r = np.random.default_rng(3)
    b = [f"w{i}" for i in range(400)]
    c = [*b[:395], *"vwxyz"]
    loose = []
    for _ in range(60):
        at = int(r.integers(0, 330))
        loose.append([*b[:at], *(f"u{r.integers(10**9)}" for _ in range(70)), *b[at + 70 :]])
    rows = list(enumerate([" ".join(x) for x in [*loose, b, c]]))
    sets = [{tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for _, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cut in ({}, {"limit": 3000, "most": 5}):
        got = fingerprints.near_pairs(docs, **cut).collect()
        root = {i: i for i, _ in rows}
        for g in got:
            assert g.like < g.id and g.jaccard == pytest.approx(len(sets[g.id] & sets[g.like]) / len(sets[g.id] | sets[g.like])) and g.jaccard >= 0.8
            root = {k: root[g.like] if v == root[g.id] else v for k, v in root.items()}
        assert root[60] == root[61]


def test_examples_that_share_a_passage_stay():
    r = np.random.default_rng(4)
    own = lambda n: [f"x{i}" for i in r.integers(0, 10**9, n)]
    passage = own(60)
    rows = [(" ".join([*passage, *own(60)]), i % 2) for i in range(50)]
    copies = [(x.rsplit(" ", 1)[0] + " changed", y) for x, y in rows[:20]]
    assert toxicity._apart(rows + copies) == rows


def test_the_pool_has_no_label(spark):
    rows = [(i, f"text {i}", "a", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(30, None), (None, 1)], "doc_id long, quality int")
    labelled, pool = quality.sample(docs, labels)
    assert {r[0] for r in labelled} == {f"text {i}" for i in range(30)}
    assert {r[0] for r in pool} == {f"text {i}" for i in range(30, 40)}
    assert quality.sample(docs, docs.selectExpr("doc_id", "1 as quality"))[1] == []
    assert quality.fit(labelled, []).meta is not None


def _components(rows, percent=85):
    """Per row (id, set size, component, kept), by comparing every two rows."""
    words = [[w for w in re.split("[ \t-\r]+", (t or "").lower()) if w] for _, t in rows]
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][0], rows[j][0]
            if sets[i] and sets[j] and None not in (a, b) and (a == b or 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])):
                root = [root[j] if x == root[i] else x for x in root]
    least = lambda i: min((rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None), default=None)
    return sorted((repr((rows[i][0], len(sets[i]), least(i), least(i) == rows[i][0])) for i in range(len(rows))))


def test_ids_with_several_texts(spark, same):
    """An id with two texts is linked with the near copies of both, whatever the order of its rows."""
    r = np.random.default_rng(6)
    text = lambda: [f"w{x}" for x in r.integers(0, 10**9, 200)]
    a, b, c, d = (text() for _ in range(4))
    near = lambda t, i: " ".join([*t[:-1], f"x{i}"])
    whole = " ".join
    rows = [(5, whole(a)), (5, whole(b)), (7, near(b, 7)), (9, near(a, 9)), (3, near(d, 3)), (8, whole(d)), (8, whole(c)), (10, near(c, 10)),
        (11, whole(c)), (5, None), (5, whole(b)), (None, whole(a)), (12, "one"), (12, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for order in (rows, rows[::-1]):
        got = near_dedup.near_duplicates(spark.createDataFrame(order, docs.schema)).collect()
        assert sorted(repr((x.id, x.n_shingles, x.component_id, x.kept)) for x in got) == _components(rows)
    import duckdb

    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    sql = con.execute(near_dedup.OP3_SQL).fetchall()
    names = [x[0] for x in con.description]
    assert sorted(repr(tuple(dict(zip(names, x))[c] for c in ("doc_id", "n_shingles", "component_id", "kept"))) for x in sql) == _components(rows)
    left = near_dedup.deduplicated(docs).collect()
    assert {(x.doc_id, x.text) for x in left} == {(None, whole(a)), (3, near(d, 3)), (5, min(whole(a), whole(b))), (12, "one")} and len(left) == 4
    pairs = {(x.id, x.like) for x in fingerprints.near_pairs(docs).collect()}
    assert pairs == {(7, 5), (9, 5), (8, 3), (10, 8), (11, 8)}


@pytest.mark.parametrize(("master", "fine"), [("local", True), ("local[4]", True), ("local-cluster[2,1,1024]", False), ("spark://host:7077", False), ("yarn", False)])
def test_a_cluster_must_name_its_shared_folder(master, fine):
    from types import SimpleNamespace

    from vellumgrid.llm import common

    conf = {}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__),
        sparkContext=SimpleNamespace(master=master, setCheckpointDir=lambda x: None))
    if fine:
        assert common.shared_dir(session).startswith("file://")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(session)
    conf["spark.checkpoint.dir"] = "hdfs://shared/x/"
    assert common.shared_dir(session) == "hdfs://shared/x"


def test_components_of_chains_hubs_and_rings(spark):
    from vellumgrid.llm.common import Scratch
    from vellumgrid.llm.components import components

    chain = [(i, i + 1) for i in range(40)]
    hub = [(1000, i) for i in range(1001, 1400)] + [(i, i) for i in range(5)]
    ring = [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)] + [(2003, 2017), (2003, 2017)]
    odd = [(None, 5), (7000, None), (3000, 3001), (-5, 3001)]
    links = spark.createDataFrame(chain + hub + ring + odd, "a long, b long")
    want = {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1400)} | {2000 + i: 2000 for i in range(30)} | {-5: -5, 3000: -5, 3001: -5}
    got = components(links, Scratch(spark, "test")).collect()
    assert {r.id: r.component for r in got} == want and len(got) == len(want)
    assert components(links.limit(0), Scratch(spark, "test")).count() == 0
