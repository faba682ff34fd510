"""The flat graph, components, registration, and the pipeline as a whole."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from orderlake.llm import flatgraph, mixing, pii, queries, toxicity
from orderlake.llm.components import components
import plain

SF = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def brute(rows, radius=0.9):
    return brute_of([(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 8, radius)


def brute_of(rows, size, radius=0.9):
    ok = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v) and len(v) == size]
    links = [(a, b) for k, (a, x) in enumerate(ok) for b, y in ok[k + 1:] if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= radius]
    c = plain.components([i for i, _ in rows], links)
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return [(i, n[i], c[i], c[i] == i) for i, _ in rows]


@pytest.mark.parametrize("cell", [3000, 60])
def test_flat_graph_finds_links(spark, cell):
    """Clusters of near vectors, copies, scaled copies and vectors that can't link; once with shards cut into blocks."""
    rng = np.random.default_rng(0)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(300, 8)))]
    center = rng.normal(size=8)
    rows += [(1000 + k, (center + 0.1 * rng.normal(size=8)).tolist()) for k in range(150)]
    rows += [(2000 + k, rows[5][1]) for k in range(20)] + [(3000, [2.5 * x for x in rows[6][1]])]
    rows += [(4000, None), (4001, [0.0] * 8), (4002, [float("nan")] + [1.0] * 7), (4003, [float("inf")] + [1.0] * 7), (4004, []), (4005, [None] + [1.0] * 7), (4006, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("node", "shard", "h1", "copies", "label")})
    r = flatgraph.near_duplicates(df, shard_size=100, max_cell=cell)
    got = sorted(tuple(x[c] for c in ("vec_id", "n_links", "component_id", "kept")) for x in r.collect())
    want = sorted(brute(rows))
    assert len(got) == len(want) and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert np.mean([g == w for g, w in zip(got, want)]) > 0.97
    assert r.first()["audit_recall"] >= 0.95
    assert flatgraph.near_duplicates(df.limit(0)).count() == 0


def test_flat_graph_finds_pairs_between_many_centres(spark):
    """Pairs alone in space at the radius, beside a large group whose links are nearly all there are."""
    rng = np.random.default_rng(4)

    def normal(n):
        v = rng.normal(size=(n, 64))
        return v / np.linalg.norm(v, axis=1, keepdims=True)
    x, z = normal(1500), normal(1500)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.901 * x + np.sqrt(1 - 0.901 ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    group = normal(1) + 0.02 * rng.normal(size=(300, 64))
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, y, group]))]
    r = flatgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard_size=15, sample=300).collect()
    c = {q["vec_id"]: q for q in r}
    assert np.mean([c[k]["component_id"] == c[1500 + k]["component_id"] == k for k in range(1500)]) >= 0.95
    assert all(c[k]["n_links"] == 299 for k in range(3000, 3300)) and r[0]["audit_recall"] >= 0.95


def test_flat_graph_compares_all_pairs_where_the_search_fails(spark):
    rng = np.random.default_rng(0)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(300, 8)))]
    r = flatgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard_size=10, max_cell=60, min_recall=1.0, tries=0).collect()
    assert sorted((x["vec_id"], x["n_links"], x["component_id"], x["kept"]) for x in r) == brute(rows) and r[0]["audit_recall"] == 1.0


def test_flat_graph_links_vectors_of_every_length(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(40)]
    rows += [(100, [1.0, 2.0]), (101, [1.0, 2.0]), (102, [1.0, 2.1]), (103, [-1.0, 2.0]), (104, [1.0, 2.0, 0.0])]
    r = {x["vec_id"]: x for x in flatgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert [r[k]["n_links"] for k in range(100, 105)] == [2, 2, 2, 0, 0] and [r[k]["component_id"] for k in range(100, 105)] == [100, 100, 100, 103, 104]


def test_robust_prune_drops_hidden_neighbours():
    x = flatgraph.unit([[1, 0, 0], [0.99, 0.1, 0], [0.98, 0.15, 0], [0, 0, 1]])
    out = flatgraph.robust_prune(x, x, np.array([[3, 2, 1, -1], [0, 2, 3, -1], [1, 0, 3, -1], [0, 1, 2, -1]]), 3, 1.2)
    assert out[0].tolist()[:2] == [1, 3]  # 2 lies behind 1


def test_search_reaches_what_is_near():
    """Graphs built by insertion: the nearest vector and all in range, in clusters and alone."""
    rng = np.random.default_rng(2)
    groups = [flatgraph.unit((rng.normal(size=16) + 0.1 * rng.normal(size=(k, 16))).tolist()) for k in (1, 2, 5, 40, 120)]
    x = np.concatenate([*groups, flatgraph.unit(rng.normal(size=(200, 16)).tolist())])
    s = flatgraph.Search(0.9)
    lists = flatgraph.build_graph(x, s)
    begin = np.tile(flatgraph.medoids(x, 8), (len(x), 1))
    near, top = flatgraph.beam_search(x, lists, x, begin, s, own=np.arange(len(x)))
    true = x @ x.T
    np.fill_diagonal(true, -2)
    assert not (near & (true < 0.9)).any() and (near & (true >= 0.9)).sum() >= 0.99 * (true >= 0.9).sum()
    assert np.mean(top[:, 0] == true.argmax(axis=1)) >= 0.95


def test_search_goes_on_in_other_shards(spark):
    """With small shards and little overlap many pairs have no shard in common: guests find them, and each pair is counted once for either."""
    rng = np.random.default_rng(3)
    rows = [(k, (c + 0.05 * rng.normal(size=16)).tolist()) for c in rng.normal(size=(40, 16)) for k in [0] * 20]
    rows = [(k, v) for k, (_, v) in enumerate(rows)]
    want = {i: (n, c) for i, n, c, _ in brute_of(rows, 16)}
    r = flatgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_size=12, overlap=2, max_cell=60, tries=1, min_recall=0.0).collect()
    assert all(x["n_links"] <= want[x["vec_id"]][0] for x in r)
    assert sum(x["n_links"] for x in r) >= 0.97 * sum(n for n, _ in want.values())


def test_cosines_in_double_precision(spark):
    rows = [(1, [1e-50, 0.0]), (2, [2e-50, 0.0]), (3, [1e300, 1e300]), (4, [1.0, 1.0]), (5, [1.0, 1.0 + 1e-12])]
    r = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in flatgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert r == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 5: (2, 3)}


def test_components_of_a_long_path(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(900, 901)], "a long, b long"))
    c = {r["node"]: r["component"] for r in components(links).collect()}
    assert c == {**{k: 0 for k in range(301)}, 900: 900, 901: 900}


def test_registration():
    names = entry.queries()
    assert [next(k for k in names if k.startswith(f"op{n}_")) for n in range(1, 14)] and "pipeline" in names
    assert set(queries.ORACLE) <= set(names)


@data
def test_mix_matches_duckdb(spark):
    import duckdb

    from tools.check_oracle import fingerprint
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    a, b = fingerprint(queries.op4_hierarchical_mix(spark, SF).toPandas()), fingerprint(con.execute(queries.OP4_SQL).df())
    assert a[:3] == b[:3]


@data
def test_pipeline_stages(spark):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)

    def step(name, d):
        out = corpus_pipeline.cut_lineage(stage[name](spark, d, SF), "test")
        assert name == "tokens" or out.columns == columns
        return out
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    a = step("toxicity", docs)
    assert {r[0] for r in a.select("doc_id").collect()} == {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["predicted"] == 0}
    b = step("near_duplicates", a)
    groups = plain.jaccard_components([(r["doc_id"], r["text"]) for r in a.collect()])
    assert sorted(r["doc_id"] for r in b.collect()) == sorted({c for _, _, c in groups})
    c = step("personal_data", b)
    before = {r["doc_id"]: r for r in b.collect()}
    for r in c.collect():
        t = before[r["doc_id"]]["text"]
        for s, k, e in reversed(plain.base_spans(t)):
            t = t[:s] + f"<{pii.KINDS[k].upper()}>" + t[e:] if not any(x < s < y for x, _, y in plain.base_spans(before[r["doc_id"]]["text"])) else t
        assert r["text"] == t and r["n_chars"] == len(t)
    d = step("mixture", c)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(c, queries.domain_of_source(), 3, 4, 3, 17, queries.DOMAIN_WEIGHTS, queries.LANG_WEIGHTS, queries.SOURCE_WEIGHTS).collect()}
    assert {r["doc_id"]: r["count"] for r in d.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}
    e = step("tokens", d)
    assert e.count() == d.count() and e.where("n_tokens <> size(ids)").count() == 0


def test_pipeline_odd_rows(spark, tmp_path):
    """Null and repeated ids, null texts, further columns, and no rows at all."""
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (None, None), (None, "mail a@b.org now please do"), (2, ""), (3, "one two three four five six")]
    df = spark.createDataFrame([(i, t, "en", "src1", len(t or ""), "x") for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, copies string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for k, d in enumerate((df, df.limit(0))):
        sf = str(tmp_path / f"sf{k}")
        d.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        out = spark.read.parquet(f"{sf}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = corpus_pipeline.cut_lineage(stage(spark, out, sf), "odd")
            assert out.columns == df.columns
            if name == "near_duplicates" and not k:
                assert out.where("text like 'one two%'").count() == 1
            if name == "personal_data" and not k:
                assert out.where("text = 'mail <EMAIL> now please do'").count() == 1
        assert corpus_pipeline.run(spark, sf).count() == out.count()


@data
def test_pipeline_holds_the_ngrams_of_few_words_at_a_time(spark, monkeypatch):
    from orderlake.llm import jaccard
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    seen, groups = [], jaccard.jaccard_groups
    monkeypatch.setattr(jaccard, "jaccard_groups", lambda d, **kw: seen.append(kw.get("block_words", 1_000_000)) or groups(d, **kw))
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).select("doc_id").collect()}
    assert seen and max(seen) <= 500_000
    assert kept == {r["doc_id"] for r in groups(docs).where("component_id = doc_id").collect()}
