"""The training-data operators on small tables: brute force, round trips, held-out accuracy and odd input."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsidio.llm import bpe, common, components, exact_dedup, langid, mixing, neardup, quality, queries, tokencount, topk, toxicity, warc

from ..conftest import same_rows

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
#: Nulls in any column, empty, blank and very long texts, ties, repeated rows, and columns with clashing names.
ODD = [
    (1, "The quick brown fox jumps over it", "en"), (2, None, "en"), (3, "", None), (4, " \t\n", "en"), (5, LONG, "en"), (None, "the QUICK brown fox jumps over it", "en"),
    (6, "the quick brown fox jumps over it", None), (6, "the quick brown fox jumps over it", None), (7, "123 !!! 456", "en"), (8, "é É ß", "de"), (9, LONG + " x", "en"), (None, None, None),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def odd(spark):
    clashing = {"node": F.lit(1), "n": F.lit("x"), "digest": F.lit("y"), "a": F.lit(2), "keep_id": F.lit(3), "score": F.lit(None).cast("double"), "part": F.lit(0), "source": F.lit(None).cast("string"), "_slot": F.lit(0)}
    return spark.createDataFrame(ODD, SCHEMA).withColumns(clashing)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA).withColumn("source", F.lit("s"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(name, spark, duck, sf):
    same_rows(queries.QUERIES[name](spark, sf), duck, queries.ORACLE[name])


# exact dedup


def test_exact_dedup_odd_rows(odd, empty):
    rows = exact_dedup.exact_dedup(odd).collect()
    assert len(rows) == len(ODD)
    fox = [r for r in rows if r.group_size == 4]
    assert {r.keep_id for r in fox} == {6} and sum(r.kept for r in fox) == 2 and len(fox) == 4
    blank = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert len(blank) == 3 and {r.keep_id for r in blank} == {3}
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == 7


def test_exact_dedup_tells_equal_digests_apart(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(60)], "doc_id long, text string")
    want = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()))
    weak = exact_dedup.exact_dedup(docs, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1).substr(1, 0))
    assert sorted(map(tuple, weak.collect())) == want


def test_batches_and_filters_change_nothing(spark, monkeypatch):
    rnd = random.Random(8)
    docs = spark.createDataFrame([(rnd.choice([i, i, i - 1, None]), rnd.choice(["A", "a", "", None, f"t{i % 90}", f"u{i}", f"U{i}"])) for i in range(500)], "doc_id long, text string")
    want = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()), key=str)
    groups = collections.defaultdict(list)
    for i, t in docs.collect():
        groups[re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")].append(i)
    plain = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        plain += [(i, top, len(ids), i == top, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert want == sorted(plain, key=str)
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs, batches=3).collect()), key=str) == want
    log = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("digest"))
    index = exact_dedup.MergeIndex(spark).append(log.filter("digest < 'b'"), 2).append(log.filter("digest >= 'b' or digest = 'a'"), 3)
    alone, shared = index._split()
    assert index.runs == 5 and alone.count() > 0 and alone.join(shared, "digest").count() == 0
    found = sorted(map(tuple, index.compact().collect()))
    monkeypatch.setattr(exact_dedup, "FILTER_BITS", 0)
    assert sorted(map(tuple, index.compact().collect())) == found and index._split()[0] is None
    monkeypatch.setattr(common, "FILTER_BITS", 0)
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()), key=str) == want


def test_deduplicated_decides_ties(spark):
    rows = [(5, "Ab", 1), (5, "ab", 2), (5, "ab", 3), (4, "AB", 4), (None, "ab", 5), (None, "x", 6), (None, "X", 7), (1, "only", 8)]
    names = ["_sha", "_kept_id", "_kept_sha", "_id", "_row", "_doc", "row", "norm", "digest", "_slot", "_bucket", "position"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int").withColumns({n: F.lit("own") for n in names})
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.filter(" or ".join(f"{n} <> 'own'" for n in names)).count() == 0
    assert sorted(r["at"] for r in kept.collect()) == [3, 6, 8] and exact_dedup.deduplicated(docs.limit(0)).count() == 0


# near duplicates


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp[max(find(i), find(j))] = min(find(i), find(j))
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str)


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(5)
    base = [[f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([3, 5, 8, 40, 120]))] for _ in range(40)]
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(260):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 10**6)}"
        if i % 3 == 0:
            w = w + passage
        rows.append((i, " ".join(x.upper() if rnd.random() < 0.1 else x for x in w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == brute_components(rows)


def test_near_duplicates_odd_rows(odd, empty):
    found = neardup.near_duplicates(odd).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == brute_components([(i, t) for i, t, _ in ODD])
    assert neardup.near_duplicates(empty).count() == 0


def test_rest_of_a_long_run_stays_in_its_group(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LONGEST_RUN", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "21")
    try:
        sets = spark.createDataFrame([(0, i, [1, 2] if i in (5, 9) else [1]) for i in range(22)] + [(0, 30, [2])], "part int, node long, prefix array<long>")
        found = {(r.token, r.node) for r in neardup.token_groups(sets.coalesce(1)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(1, i) for i in range(22)} <= found and {(2, 5), (2, 9), (2, 30)} <= found


def test_tree_join_drops_no_link():
    rnd = np.random.default_rng(1)
    universe = rnd.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
    sets = [np.unique(rnd.choice(universe[: rnd.integers(60, 300)], rnd.integers(20, 200))) for _ in range(150)]
    sets += [np.unique(np.concatenate((s[2:], universe[-2:]))) for s in sets[:60]]
    sizes, maps = np.array(list(map(len, sets))), np.array([neardup.bitmap(s) for s in sets])
    order = np.argsort(sizes)
    tree = neardup.SignatureTree(sizes[order], maps[order], np.arange(len(sets)))
    i, j = neardup.tree_join(tree)
    found = {frozenset((int(order[a]), int(order[b]))) for a, b in zip(i, j, strict=True)}
    x, y = order[::2], order[1::2]
    a, b = (neardup.SignatureTree(sizes[o], maps[o], o) for o in (x, y))
    i2, j2 = neardup.tree_join(a, b)
    across = {frozenset((int(x[p]), int(y[q]))) for p, q in zip(i2, j2, strict=True)}
    links = 0
    for p in range(len(sets)):
        for q in range(p):
            shared = len(np.intersect1d(sets[p], sets[q]))
            if 100 * shared >= 80 * (len(sets[p]) + len(sets[q]) - shared):
                links += 1
                assert {p, q} in found
                assert ({p, q} in across) or (p in x) == (q in x)
    assert links >= 20 and len(found) < len(sets) ** 2 / 4


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(200)]
    comp = {}
    for a, b in links:
        if a != b:
            comp.setdefault(a, a), comp.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    found = components.connected_components(spark.createDataFrame([*links, (None, 1)], "a long, b long"))
    assert {r.node: r.comp for r in found.collect()} == comp
    assert components.connected_components(found.limit(0), "node", "comp").isEmpty()
    half = common.materialise(components.connected_components(spark.createDataFrame(links[::2], "a long, b long")), "test-half")
    for rest in (links, links[1::2]):
        both = components.joined_up(half, spark.createDataFrame([x for x in rest if x[0] != x[1]], "a long, b long"))
        assert {r.node: r.comp for r in both.collect()} == comp
    assert components.joined_up(half, spark.createDataFrame(links[:1], "a long, b long")).count() == half.count()


# BPE


def test_bpe_matches_the_library(spark, odd, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    library.no_truncation(), library.no_padding()
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aaabcdehlnostxyz'  .!09éßñΣİſ \x1c\x85<|³½ǅ漢ひ한́🙂﻿Kẞ") for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["x<|endoftext|>y <|startoftext|><|endoftext|>", "AAAAAAA aaaaaa aaaaa", "'S 'LL don't", LONG]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in bpe.encode_texts(docs).collect()}
    for i, t in enumerate(texts):
        want = library.encode(t, add_special_tokens=False)
        assert found[i].ids == " ".join(map(str, want.ids)) and found[i].n_tokens == len(want.ids)
        assert found[i].decoded == library.decode(want.ids, skip_special_tokens=False)
    again = {r.doc_id: r.decoded for r in bpe.decode_ids(bpe.encode_texts(docs)).collect()}
    assert again == {i: r.decoded for i, r in found.items()}
    rows = bpe.encode_texts(odd).collect()
    assert len(rows) == len(ODD) and all(r.n_tokens == 0 and r.ids == "" for r in rows if r.doc_id in (2, 3, 4))
    assert bpe.encode_texts(empty).count() == 0


def test_bpe_matches_the_library_on_every_character():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(bpe.default_path()), bpe.tokenizer(bpe.default_path())
    library.no_truncation(), library.no_padding()
    rnd = random.Random(6)
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x10000), *range(0x10400, 0x10450), *range(0x1F600, 0x1F650)]]
    texts = [f"a{c}b" for c in chars] + [f"{c}{d} {c}" for c, d in zip(chars, rnd.sample(chars, len(chars)), strict=True)]
    texts += ["".join(rnd.choice(chars[:0x250]) for _ in range(rnd.randint(1, 12))) for _ in range(40_000)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text)[0] == " ".join(map(str, want.ids)), ascii(text)
    assert own.decode([10**9, 320, -1]) == own.decode([320])


def test_automaton_on_merges_of_its_own():
    merges = [("a", "a"), ("aa", "a"), ("a", "b"), ("aa", "aa"), ("b", "ab"), ("aaa", "b")]
    vocab = {s: i for i, s in enumerate(["a", "b", *("".join(m) for m in merges)])}
    automaton = bpe.Automaton(vocab, merges)

    def plain(word):
        parts = list(word)
        while True:
            best = min(((merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in merges), default=None)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    for n in range(1, 11):
        for k in range(2**n):
            word = format(k, f"0{n}b").replace("0", "a").replace("1", "b")
            assert automaton.emit(automaton.read(word)) == plain(word), word


# token counts


def test_edited_counts_match_recounts(odd, empty):
    using, rnd = tokencount.counter(), random.Random(4)
    letters = "aab 's  \n\n\t're'll12 é.,!%x"
    for _ in range(300):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 400)))
        tree = tokencount.TokenTree(text, using)
        for _ in range(6):
            at, gone, new = rnd.randint(0, len(text) + 2), rnd.choice([0, 1, 5, 300]), "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 8, 900])))
            tree.edit(at, gone, new)
            text = text[: min(at, len(text))] + new + text[min(at, len(text)) + gone :]
            assert tree.text() == text and tree.n_tokens == len(using.encoding.encode_ordinary(text))
            again = tokencount.TokenTree.restored(using, *tree.stored())
            assert again.stored() == tree.stored()
            tree = again
    trees = tokencount.build_trees(odd)
    rows = tokencount.apply_edits(tokencount.scripted_edits(trees)).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.n_tokens == len(using.encoding.encode_ordinary(r.text)) and r.n_recounted <= 60
    assert tokencount.apply_edits(tokencount.scripted_edits(tokencount.build_trees(empty))).count() == 0


def test_later_edits_of_stored_trees(spark):
    using = tokencount.counter()
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, LONG), (3, "other"), (None, "x")], "doc_id long, text string").withColumn("tokens", F.lit("clash"))
    schema = "doc_id long, seq int, at long, deleted long, inserted string"
    first = spark.createDataFrame([(1, 2, 0, 4, ""), (1, 1, 4, 3, "2"), (2, 1, None, None, None), (3, None, 0, 0, "New "), (None, 1, 0, 1, "z"), (9, 1, 0, 1, "z")], schema).withColumn("chars", F.lit(1))
    trees = common.materialise(tokencount.build_trees(docs), "test-trees")
    once = common.materialise(tokencount.apply_edits(tokencount.attach_edits(trees, first)).select("doc_id", *tokencount.TREE_COLUMNS), "test-trees")
    assert sorted(r.text[:7] for r in once.collect()) == sorted(["2 three", "", "New wor", "New oth", "x"])
    second = spark.createDataFrame([(3, 1, 300_000, 5, " again "), (1, 1, 0, 0, "1 ")], schema)
    rows = tokencount.apply_edits(tokencount.attach_edits(once, second)).collect()
    assert len(rows) == 5 and all(r.n_tokens == len(using.encoding.encode_ordinary(r.text)) for r in rows)
    long = max(rows, key=lambda r: r.n_pieces)
    assert " again " in long.text and long.n_recounted < 20 < long.n_pieces
    untouched = tokencount.apply_edits(tokencount.attach_edits(once, second.limit(0))).collect()
    assert all(r.n_tokens == r.n_tokens_before and r.n_recounted == 0 for r in untouched) and len(untouched) == 5


# mixing


def plain_mixture(rows, weights, block_rows):
    """(source, block) of every slot, by exact arithmetic: fluid times of blocks, then earliest deadline first."""
    from fractions import Fraction

    names = sorted({s for _, s in rows}, key=lambda s: "n" if s is None else f"={s}")
    left = {s: -(-sum(x == s for _, x in rows) // block_rows) for s in names}
    weight = {s: Fraction(weights.get(s, 1.0)) for s in names}
    ends = {s: [(k + 1) / weight[s] for k in range(left[s])] for s in names}
    last = {s: ends[s][-1] for s in names}

    def slot_of(v):  # the fluid schedule has served so many blocks when every source is at v
        return sum(min(v, last[s]) * weight[s] for s in names)

    margin, windows = Fraction(1, 128), []
    for i, s in enumerate(names):
        for k, v in enumerate(ends[s]):
            before = slot_of(ends[s][k - 1]) if k else Fraction(0)
            windows.append(((before + margin).__floor__(), (slot_of(v) - margin).__ceil__(), i, k))
    served = []
    while windows:
        ready = min((w for w in windows if w[0] <= len(served)), key=lambda w: (w[1], w[2], w[3]))
        windows.remove(ready)
        served.append((names[ready[2]], ready[3]))
    return served


def test_mix_matches_a_plain_schedule(spark):
    rnd = random.Random(3)
    for weights in ({"a": 3.0, "b": 1.0, None: 2.0}, {"a": 1.0, "b": 0.37, "c": 5.5, "d": 1 / 3}, {"a": 1e6, "b": 1.0}):
        rows = [(i, rnd.choice([*weights, "z"])) for i in range(300)]
        found = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_rows=4).collect()
        slots = {r.slot: (r.source, r.block) for r in found}
        assert [slots[k] for k in range(len(slots))] == plain_mixture(rows, weights, 4)


def test_mix_keeps_every_row(spark, odd, empty):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 20, None).otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    rows = mixing.mix(docs, {"hot": 3.0, None: 2.0}, block_rows=16).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000)) and len({r.position for r in rows}) == 3000
    by_block = collections.Counter((r.source, r.block) for r in rows)
    last = {s: max(b for t, b in by_block if t == s) for s, _ in by_block}
    assert all(n == 16 for (s, b), n in by_block.items() if b < last[s])
    first = collections.Counter(r.source for r in sorted(rows, key=lambda r: r.position)[: 10 * 16])
    assert first["hot"] == max(first.values())
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"hot": -1.0})


def deviations(slots, weights):
    """The largest distance of a source from its fluid share after any slot, by exact arithmetic. ``slots``: sources in order of slots."""
    from fractions import Fraction

    left, weight = collections.Counter(slots), {s: Fraction(w) for s, w in weights.items()}
    v, at, kinks = Fraction(0), 0, []
    for s in sorted(left, key=lambda s: left[s] / weight[s]):  # the slot at which v is reached, kink by kink
        active = sum(weight[x] for x in left if left[x] / weight[x] >= left[s] / weight[s])
        end = left[s] / weight[s]
        kinks.append((at, v, active))
        at, v = at + (end - v) * active, end
    kinks.append((at, v, Fraction(1)))
    count, worst, i = dict.fromkeys(left, 0), 0, 0
    for t, s in enumerate(slots, 1):
        count[s] += 1
        while i + 1 < len(kinks) and kinks[i + 1][0] <= t:
            i += 1
        now = kinks[i][1] + (t - kinks[i][0]) / kinks[i][2]
        worst = max(worst, *(float(abs(n - min(weight[x] * now, left[x]))) for x, n in count.items()))
    return worst


def test_mix_keeps_the_bound_over_many_slots(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 19)).alias("source"))
    sizes = {r[0]: r[1] for r in docs.groupBy("source").count().collect()}
    for weights in (None, {"hot": 2.5, "s1": 0.013, "s2": 1 / 3}):
        rows = mixing.mix(docs, weights, block_rows=1).select("source", "slot").toPandas().sort_values("slot")
        assert rows.slot.tolist() == list(range(30_000))
        assert deviations(rows.source.tolist(), {s: weights.get(s, 1.0) if weights else n**0.5 for s, n in sizes.items()}) < 1


def test_slots_do_not_depend_on_the_stretch(spark):
    rows = spark.range(2000).select(F.concat(F.lit("="), F.floor(F.sqrt("id")).cast("string")).alias("_name"))
    sizes, windows = mixing.plan_of(rows, {"3": 7.0}, 3)
    n = sizes.agg(F.sum("_blocks")).first()[0]
    found = [sorted(map(tuple, mixing.slots_of(windows, n, k).collect())) for k in (n, 97)]
    assert found[0] == found[1] and sorted(x[2] for x in found[0]) == list(range(n))
    due = {(r._sid, r._block): (r._release, r._deadline) for r in windows.collect()}
    assert all(due[s, b][0] <= t < due[s, b][1] for s, b, t in found[0])


def test_mix_takes_any_number_of_sources(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 997)).alias("source"))
    rows = mixing.mix(docs, block_rows=2).toPandas()
    assert sorted(rows.doc_id) == list(range(4000)) and rows.position.is_unique and rows.source.nunique() == 998
    slots = rows.groupby("slot").source.first()
    assert (rows.groupby("slot").source.nunique() == 1).all() and slots.index.tolist() == list(range(len(slots)))
    assert deviations(slots.tolist(), rows.source.value_counts().pow(0.5).to_dict()) < 1


# WARC


def test_bundles_round_trip(spark, tmp_path):
    rows = [(1, "a", "x"), (2, None, "x"), (3, "u\n v", "x"), (4, "b", None), (5, "c", ""), (6, "d", "yé"), (6, "d", "yé"), (None, "q", "z"), (7, "l", LONG * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("frame", F.lit(1)).withColumn("sha256", F.lit(2))
    path = f"file://{tmp_path}/warc"
    warc.write_bundles(pages, path)
    found = warc.read_bundles(spark, path).collect()
    assert len(found) == len(rows)
    kept = {r.page_id: r for r in found}
    assert {i: kept[i].record_type for i in (1, 2, 3, 4, 5, 6, 7)} == {1: "revisit", 2: "revisit", 3: "response", 4: "revisit", 5: "response", 6: "response", 7: "response"}
    assert kept[1].refers_to == 3 and kept[4].refers_to == 5 and bytes(kept[7].payload).decode() == LONG * 2
    import base64

    assert all(kept[i].payload_digest == base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for i, _, h in rows if i)
    import io

    import zstandard

    for f in (tmp_path / "warc").glob("part-*"):
        data = f.read_bytes()
        if data:
            whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
            bundle = warc.Bundle(data)
            assert whole.startswith(b"WARC/1.1\r\n") and len(whole) == sum(raw for _, _, raw in bundle.frames)
            for page_id, *_ in bundle.index:
                assert all(x["page_id"] == page_id for x in bundle.fetch(page_id))
    assert warc.archive(pages.limit(0)).count() == 0


@pytest.mark.parametrize(("most_rows", "most_bytes"), [(4, 1 << 30), (16, 3000)])
def test_bundles_roll_over(spark, tmp_path, most_rows, most_bytes):
    rnd = random.Random(7)
    rows = [(None if i == 50 else i, f"u{i}", "".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(0, 900)))) for i in range(200)]
    path = f"file://{tmp_path}/warc"
    writer, files, held = warc.BundleWriter(2000, most_rows, most_bytes), [], []
    for i, u, h in rows:
        for x in writer.add(warc._record(i, u, h.encode(), hashlib.sha1(h.encode()).hexdigest(), len(h), None, False), i):
            held.append(x)
    held += writer.end()
    for at in range(0, len(held), most_rows):  # as the writer does
        files.append(b"".join(x + warc.SEPARATOR.encode() for x in held[at : at + most_rows]))
    found = [x for f in files for *_, x in warc.Bundle(f).records()]
    assert len(files) > 3 and [(x["page_id"], x["payload"].decode()) for x in found] == [(i, h) for i, _, h in rows]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_bundles(pages, path, 0, 2000, most_rows, most_bytes)
    parts = sorted(tmp_path.glob("warc/part-*"))
    assert len(parts) == len(files) and warc.read_bundles(spark, path).count() == len(rows)
    ranged = warc.open_bundle(spark, f"file://{parts[1]}")
    some = ranged.index[3][0]
    assert ranged.fetch(some)[0]["page_id"] == some and ranged.data.read < len(ranged.data)
    assert sum(len(warc.Bundle(p.read_bytes()).fetch(None)) for p in parts) == 1 and sum(len(warc.Bundle(p.read_bytes()).fetch(0)) for p in parts) == 1


# search


def test_top_k_matches_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(2)
    rows = [(i, rnd.normal(size=20).round(2).tolist()) for i in range(900)] + [(1000, None), (1100, [1.0, None]), (1200, [float("nan")] * 20), (300, rows0 := [0.0] * 20), (1300, []), (1301, []), (1400, [3e30] * 20), (None, rows0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    valid = [(i, [int(np.floor(x * 1024.0)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want, seen = [], {}
    for i, v in sorted(valid):
        if i % 100 == 0 and i not in seen:
            seen[i] = v
    for i, v in seen.items():
        clip = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
        best = sorted(((clip(sum(a * b for a, b in zip(v, w, strict=True))), j) for j, w in valid if j != i and len(w) == len(v)), key=lambda x: (-x[0], x[1]))[:10]
        want += [(i, r, j, s) for r, (s, j) in enumerate(best, 1)]
    assert sorted(map(tuple, topk.top_k(df).collect())) == sorted(want)
    assert topk.top_k(df.limit(0)).count() == 0
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    assert sorted(map(tuple, topk.top_k(df).collect())) == sorted(want)


# models


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1.0
    n1 = labels.sum()
    return (order[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


@pytest.mark.parametrize(("model", "label", "least"), [(toxicity, "toxic", 0.9), (quality, "quality", 0.9)])
def test_classifiers_on_held_out_rows(model, label, least, spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fitted = model.fit(docs, labels)
    scored = model.score(docs, fitted).join(labels, "doc_id").filter(common.held_out(F.col("doc_id"))).select("score", label).toPandas()
    assert auc(scored.score.to_numpy(), scored[label].to_numpy()) >= least
    rows = model.score(odd, fitted).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert model.score(empty, fitted).count() == 0
    untrained = model.fit(docs, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in model.score(odd, untrained).collect())


def test_segments_are_those_of_the_definition():
    rnd = random.Random(9)
    for _ in range(200):
        s = [rnd.choice([-3, -2, -1, 1, 2, 4]) for _ in range(rnd.randint(1, 14))]

        def split(a, b, s=s):
            best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            if best[0] <= 0:
                return []
            i, j = best[3:]
            return [*split(a, i), (i, j, best[0]), *split(j, b)]

        assert [x[2] for x in toxicity.maximal_segments(np.array(s, float))] == [x[2] for x in split(0, len(s))]


def test_isotonic_is_the_best_rising_fit():
    x, y = quality.isotonic(np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 1, 0, 1, 0, 1]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all()


def test_languages_on_held_out_rows(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = langid.fit(docs)
    found = langid.identify(docs, profiles).join(docs, "doc_id").filter(common.held_out(F.col("doc_id"))).select((F.col("lang") == F.col("lang_pred")).alias("right")).toPandas()
    assert found.right.mean() > 0.97
    rows = langid.identify(odd, profiles).collect()
    assert len(rows) == len(ODD) and all((r.lang_pred == "und") == (r.doc_id in (2, 3, 4, 7) or (r.doc_id is None and r.score == 0)) for r in rows)
    assert langid.identify(empty, profiles).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(empty)).collect()} == {"und"}


# pipeline


def test_pipeline_matches_a_plain_version(spark, sf):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    lower = lambda t: re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    rows = {r.doc_id: r.text for r in docs.itertuples() if r.text and any(map(str.isalpha, r.text))}
    last = {}
    for i, t in sorted(rows.items()):
        last[lower(t)] = i
    rows = {i: rows[i] for i in last.values()}
    comps = {i: c for i, _, c in brute_components(sorted(rows.items()))}
    rows = {i: t for i, t in rows.items() if comps[i] == i}
    library = Tokenizer.from_file(bpe.default_path())
    library.no_truncation(), library.no_padding()
    want = {i: hashlib.sha256(" ".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for i, t in rows.items()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf).collect()} == want


NAMES = "_sha _kept_id _kept_sha _id _position _row _doc row number place position slot block source_ _key _source _name _u _tie _keep _slot _bucket _bits component_id digest norm doc text_ rank tokens".split()


def test_stages_take_odd_rows(spark, odd, sf):
    """Nulls, empty and very long texts, ties, repeated rows and clashing names, and nothing at all, through all stages."""
    import corpus_pipeline

    clashing = odd.withColumns({n: F.lit(f"own {n}") for n in NAMES})
    docs, none = clashing, clashing.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, none = (common.materialise(stage(spark, x, sf), "test-stage") for x in (docs, none))
        assert docs.columns == none.columns == clashing.columns
        assert docs.filter(" or ".join(f"{n} is null or {n} <> 'own {n}'" for n in NAMES)).isEmpty() and none.isEmpty()
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, none, sf).count() == 0
    # the fox of the largest id, the one of LONG with the smallest, and the letters
    assert sorted(r.doc_id for r in docs.collect()) == [5, 6, 8] == sorted(r.doc_id for r in last(spark, docs, sf).collect())


def test_stages_decide_by_row(spark, sf):
    import corpus_pipeline

    words = [f"word{i}" for i in range(40)]
    a, b, c = " ".join(words), " ".join([*words[:-1], "other"]), " ".join(words[::-1])
    rows = [(None, "12 !!", 0), (None, "plain words", 1), (None, None, 2), (7, "--", 3), (7, "more words", 4), (8, a, 5), (None, b, 6), (9, b, 7), (9, c, 8), (None, "x1 x2 x3", 9), (None, "x1 x2 x3", 10), (None, "", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int").withColumn("score", F.lit(1))
    for lang in (F.lit(None).cast("string"), F.lit("en")):
        left = corpus_pipeline.language(spark, docs.withColumn("lang", lang), sf)
        assert sorted(r["at"] for r in left.collect()) == [1, 4, 5, 6, 7, 8, 9, 10]
    kept = corpus_pipeline.near(spark, docs, sf)
    assert kept.columns == docs.columns
    kept = {r["at"] for r in kept.collect()}
    assert kept - {9, 10} == {0, 1, 2, 3, 4, 5, 8, 11} and len(kept & {9, 10}) == 1


def test_places_of_the_mixture_reach_the_result(spark, sf):
    import corpus_pipeline

    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 200, None).otherwise(F.concat(F.lit("s"), F.col("id") % 5))
    docs = spark.range(6000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t "), F.col("id")).alias("text"), source.alias("source"))
    docs = common.materialise(docs, "test-docs")
    mixed = common.materialise(corpus_pipeline.mixed(spark, docs, sf), "test-mixed")
    rows = corpus_pipeline.encoded(spark, mixed, sf).toPandas().sort_values("position")
    assert len(rows) == 6000 and rows.position.is_unique
    stored = mixed.select("text", "_metadata.file_name", "_metadata.row_index").toPandas().sort_values(["file_name", "row_index"])
    numbered = mixed.select(F.substring("text", 3, 9).cast("long").alias("doc_id"), "text")
    ids = {f"t {r.doc_id}": hashlib.sha256(r.ids.encode()).hexdigest() for r in bpe.encode_texts(numbered).collect()}
    assert [ids[t] for t in stored.text] == rows.ids_sha256.tolist()
    slots = rows.fillna({"source": "null"}).groupby("slot").source.agg(["first", "nunique"])
    assert (slots["nunique"] == 1).all() and slots.index.tolist() == list(range(len(slots)))
    sizes = rows.source.fillna("null").value_counts()
    assert deviations(slots["first"].tolist(), sizes.pow(0.5).to_dict()) < 1
