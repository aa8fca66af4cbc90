"""Small cases of the findings of round 2; each failed before."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from obsidio.functions import clean, geo, text
from obsidio.llm import common, mixing, tokencount
from obsidio.operators import joins, resolve
from obsidio.plans import documents, history, matching, models, registry, resolution

from .conftest import same_rows


def test_years_of_five_digits_have_no_sign(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05' + make_dt_interval(9000000) AS t UNION ALL SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05'")
    assert {r[0] for r in rows.select(history.stamp("t")).collect()} == {"26665-03-02 03:04:05", "2024-01-02 03:04:05"}


def test_postcode_is_not_a_house_number_of_five_digits(spark):
    texts = ["Weg 12345, 10115 Berlin", "Weg 12345 10115 Berlin", "10115 Berlin, Weg 12", "10115 Berlin Weg 12345", "Weg 1,D-10115 Berlin", "10115", "Weg 1", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", clean.postcode(F.col("t")).alias("p")).orderBy("i").collect()
    assert [r.p for r in rows] == [*["10115"] * 6, None, None]


def test_title_keeps_other_references(spark, duck, tmp_path):
    titles = ["a &lt;b&gt; &amp;amp;", "x &quot;y", "cut &amp", " &auml; ", ""]
    spark.createDataFrame([(i, f'<html lang="de"><head><title>{t}</title></head></html>') for i, t in enumerate(titles)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: r.title for r in documents.html_extract(spark, str(tmp_path)).collect()}
    assert found == {0: "a <b> &amp;", 1: "x &quot;y", 2: "cut &amp", 3: "&auml;", 4: None}
    full = text.extract_page("<title>x &quot;y</title>")
    assert (full["title"], full["title_source"]) == ('x "y', "x &quot;y")


def test_all_made_places_are_in_the_market(spark, tmp_path):
    spark.createDataFrame([(k,) for k in (1, 499, 500, 700, 5999, 60000)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    areas = models.raw_tables(spark, str(tmp_path), {"osm"})["geo_area"]
    points = spark.createDataFrame([(k, 52 + k / 1000, 13 + k / 1000) for k in (1, 499, 500, 700, 5999, 60000)], "k long, lat double, lon double")
    covered = geo.covering_areas(points, areas).collect()
    assert len(covered) == 6 and all(r.areas["market"].code == "B" and r.areas["postcode"].code == "10999" for r in covered)


PARTS = [(k, n, b, s) for k, (n, b, s) in enumerate([("red bolt", "B1", 1), ("red bolt", "B1", 1), ("red gear", "B1", 3), (None, "B1", 1), ("red bolt", None, 1), ("old ring", "B2", 50), ("red bolt", "B2", 2)] * 60)]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """A table of parts with many copies and nulls, and DuckDB on it."""
    folder = tmp_path_factory.mktemp("parts")
    spark.createDataFrame(PARTS, "p_partkey long, p_name string, p_brand string, p_size int").coalesce(1).write.parquet(f"{folder}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet/*.parquet'")
    return str(folder), con


def test_blocked_pairs_are_counted_with_nulls_and_without_pairs(spark, parts):
    folder, con = parts
    found = matching.blocking_pairs(spark, folder)
    same_rows(found, con, registry.oracle_sql()["blocking_pairs"])
    assert "Generate" in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and "Join" not in plan
    assert joins.union_blocks_totals(spark.range(3), "id", [F.col("id")], 31, 1).collect() == [(0, None)]


@pytest.mark.parametrize("name", ["deterministic_pairs", "connected_components"])
def test_pairs_of_parts_with_copies_and_nulls(name, spark, parts):
    folder, con = parts
    same_rows(registry.queries()[name](spark, folder), con, registry.oracle_sql()[name])


def test_links_of_parts_are_few_and_whole(spark, parts):
    """Two parts match by a rule exactly when classes and pairs of classes say so; rows grow with parts, not with pairs."""
    folder, con = parts
    rows = matching.deterministic_pairs(spark, folder).collect()
    home = {(r.rule, r.b): r.a for r in rows if r.kind == "member"}
    linked = {(r.a, r.b) for r in rows if r.kind == "pair"}
    expected = con.execute("""SELECT a.p_partkey, b.p_partkey, (a.p_partkey % 97 = b.p_partkey % 97 AND jaro_winkler_similarity(a.p_name, b.p_name) >= 0.75) IS TRUE,
        (a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_name = b.p_name) IS TRUE FROM part a JOIN part b ON a.p_partkey < b.p_partkey""").fetchall()
    for a, b, phone, place in expected:
        x, y = home.get(("phone+name", a)), home.get(("phone+name", b))
        assert phone == (x is not None and y is not None and (x == y or (min(x, y), max(x, y)) in linked))
        x, y = home.get(("address+name", a)), home.get(("address+name", b))
        assert place == (x is not None and x == y)
    assert len(rows) < 4 * len(PARTS) < sum(p or q for *_, p, q in expected)


def test_near_customers_are_members_and_pairs_of_places(spark, tmp_path):
    spark.range(14_000).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    found = matching.haversine_pairs(spark, str(tmp_path))
    counts = {r[0]: r[1] for r in found.groupBy("kind").count().collect()}
    assert counts["member"] == 14_000 and found.filter("kind = 'member' and b % 7000 <> a").count() == 0 and found.filter("kind = 'pair' and (a >= b or b >= 7000)").count() == 0


def test_scores_count_every_compared_pair(spark, sf):
    """Counts and weights by part equal those of the pairs."""
    gammas = ["g_name", "g_brand", "g_size", "g_phone"]
    pairs = resolve.match_scores(resolution._gammas(spark, sf), gammas, [3, 2, 2, 2], fixed_m={0: [0.1, 0.3, 0.6]}).collect()
    expected = Counter((k, *[r[g] for g in gammas], round(r.match_weight, 5)) for r in pairs for k in (r.a, r.b))
    rows = resolution.fs_scores(spark, sf).collect()
    found = {(r.k, *[x[g] for g in gammas], round(x.match_weight, 5)): x.links for r in rows for x in r.scores}
    assert len(pairs) > 100 and found == dict(expected) and all(r.links == sum(x.links for x in r.scores) for r in rows)


def test_counts_by_level_with_nulls():
    names = np.array(["a b", "a b", "b c", None, "d", "a b"] * 3, dtype=object)
    brands = np.array(["x", None, "x", "x", "y", "y"] * 3, dtype=object)
    sizes = np.array([1, 2, 4, 3, np.nan, 9.0] * 3)
    out = resolve.count_levels(names, brands, sizes, 2)
    expected = np.zeros_like(out)
    for i in range(len(names)):
        for j in range(len(names)):
            if i != j:
                whole = names[i] is not None and names[j] is not None
                level = 2 if whole and names[i] == names[j] else 1 if whole and set(names[i].split(" ")) & set(names[j].split(" ")) else 0
                expected[i, level, int(brands[i] is not None and brands[i] == brands[j]), int(abs(sizes[i] - sizes[j]) <= 2)] += 1
    assert (out == expected).all()


def test_clusters_without_links_equal_those_by_links(spark, parts, tmp_path, monkeypatch):
    """Copies, nulls and a key in two names; no pair of parts is made."""
    more = [(k, n, b, s) for k, (n, b, s) in enumerate([("red bolt", "B1", 1), ("red bolt", "B2", 3), ("red gear", "B1", 3), ("red gear", "B1", 6)] * 40)]
    rows = [*PARTS, *[(1000 + k, n, b, s) for k, n, b, s in more], (1001, "old ring", "B2", 50), (1001, "red gear", "B1", 3), (1003, "lone", "B9", 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    nodes = resolution._listings(spark, str(tmp_path)).select("k", "platform", "lat", "lon").distinct().collect()
    edges = [tuple(r) for r in resolution._edges(spark, str(tmp_path)).select("a", "b", "p").distinct().collect()]
    expected = resolve.greedy_clusters(edges, {r.k: r.platform for r in nodes}, {r.k: (r.lat, r.lon) for r in nodes}, {0, 1, 2}, 40_000.0)
    monkeypatch.setattr(resolution, "_edges", None)
    found = [tuple(r) for r in resolution.constrained_clusters(spark, str(tmp_path)).collect()]
    assert len(set(expected.values())) > 10 and len(found) == len(set(found)) and dict(found) == expected


@pytest.mark.parametrize("span", [300.0, 3_000.0])
def test_greedy_cells_with_odd_places(span):
    rng = np.random.default_rng(7)
    n = 300
    kinds = [["a", "b", "c", None][k] for k in rng.integers(0, 4, n)]
    places = [(52 + x / 1000, 13 + y / 1000) for x, y in rng.integers(0, 20, (n, 2))]
    places[5] = places[9] = (float("nan"), 13.0)
    own = [[(int(x),)] for x in rng.integers(0, 40, n)], [[("x", int(x)), ("y", int(y))] for x, y in rng.integers(0, 25, (n, 2))]
    links = [(own[0], own[0]), (own[1], own[1])]
    edges = [(a, b, p) for p, o in zip((1.0, 0.8), own, strict=True) for a in range(n) for b in range(a + 1, n) if set(o[a]) & set(o[b])]
    expected = resolve.greedy_clusters(edges, dict(enumerate(kinds)), dict(enumerate(places)), {"a", "b"}, span)
    found = resolve.greedy_cells(links, kinds, places, {"a", "b"}, span)
    assert {i: c for i, c in enumerate(found) if c >= 0} == expected and len(set(found)) > 20
    assert resolve.greedy_cells([([[1], [2]], [[1], [2]])], ["a", "b"], [(0, 0)] * 2, {"a"}, span) == [-1, -1]


def test_texts_are_not_moved_for_their_places(spark, monkeypatch):
    """Without broadcasts of Spark's own choice; the plan has no join that moves rows, and the join gives the same."""
    docs = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t "), F.col("id")).alias("text"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("source"))
    docs = common.materialise(docs.repartition(5), "test-docs")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed, ordered = mixing.placed_rows(docs), mixing.in_order(docs)
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (placed, ordered)]
        moved = [[line for line in plan.splitlines() if "SortMergeJoin" in line or "Exchange hashpartitioning" in line] for plan in plans]
        assert moved == [[], []] and [p.count("BroadcastHashJoin") for p in plans] == [2, 1]
        found = [sorted(placed.select("row.text", "place.*").collect()), [r.text for r in ordered.collect()]]
        monkeypatch.setattr(mixing, "MOST_LISTED", 0)
        joined = [sorted(mixing.placed_rows(docs).select("row.text", "place.*").collect()), [r.text for r in mixing.in_order(docs).collect()]]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert found == joined and len(found[0]) == len(found[1]) == 3000 and placed.schema.simpleString() == mixing.placed_rows(docs).schema.simpleString()
    assert mixing.placed_rows(docs.limit(0)).count() == mixing.in_order(docs.limit(0)).count() == 0


def test_stored_trees_open_only_edited_leaves():
    using = tokencount.counter()
    tree = tokencount.TokenTree("some words, 12 of them; " * 2000, using)
    again = tokencount.TokenTree.restored(using, *tree.stored())
    again.edit(3000, 5, "other")
    assert sum(leaf is not None for leaf in again.leaves) <= 2 < len(again.leaves)
    assert again.n_pieces == len(using.pattern.findall(again.text())) and again.n_tokens == len(using.encoding.encode_ordinary(again.text()))
