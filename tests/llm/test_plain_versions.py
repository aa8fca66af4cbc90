"""The fitted operators against plain versions, and every registered query as the driver calls it."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsidio.llm import langid, neardup, quality, queries, toxicity

from .test_operators import brute_components


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# toxicity


def plain_words(text):
    return [w.strip(toxicity.PUNCTUATION) for w in (text or "").lower().split()]


def plain_tables(rows):
    """Scores of words and stems from (text, label), by the formulas of the operator's docstring."""
    seen = {0: collections.Counter(), 1: collections.Counter()}
    for text, label in rows:
        seen[label].update({w for w in plain_words(text) if w})
    n = {y: sum(seen[y].values()) for y in (0, 1)}
    base = n[1] / (n[0] + n[1])
    stems = {y: collections.Counter() for y in (0, 1)}
    for y in (0, 1):
        for w, k in seen[y].items():
            stems[y][w[: toxicity.STEM]] += k

    def scored(a, b, prior_toxic, prior_other):
        s = math.log((a + prior_toxic) / n[1]) - math.log((b + prior_other) / n[0])
        s = max(-toxicity.MOST_SCORE, min(toxicity.MOST_SCORE, s))
        return s if abs(s / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))) >= toxicity.LEAST_Z else 0.0

    of_stems = {x: scored(stems[1][x], stems[0][x], toxicity.STEM_PRIOR * base, toxicity.STEM_PRIOR * (1 - base)) for x in stems[0] | stems[1]}
    of_words = {}
    for w in seen[0] | seen[1]:
        a, b, x = seen[1][w], seen[0][w], w[: toxicity.STEM]
        share = (stems[1][x] + toxicity.STEM_PRIOR * base) / (stems[1][x] + stems[0][x] + toxicity.STEM_PRIOR)
        s = scored(a, b, toxicity.WORD_PRIOR * share, toxicity.WORD_PRIOR * (1 - share))
        if a + b >= 20 or a + b >= 3 and s:
            of_words[w] = s
    return of_words, of_stems


def test_toxicity_matches_a_plain_version(spark):
    rnd = random.Random(2)
    bad, good = [f"vile{i}" for i in range(12)], [f"plain{i}x" for i in range(200)]
    texts = {}
    for i in range(600):
        words = rnd.choices(good, k=rnd.randint(5, 60))
        if i % 4 == 0:
            at = rnd.randrange(len(words))
            words[at:at] = [rnd.choice(bad) + rnd.choice(["", "ly", "!"]) for _ in range(rnd.randint(3, 8))]
        texts[i] = " ".join(words)
    labels = [(i, int(i % 4 == 0)) for i in texts]
    docs = spark.createDataFrame([*texts.items(), (700, None), (701, ""), (702, "vile3 vile4 unknown")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    words, stems = plain_tables([(texts[i], y) for i, y in labels if not held(i)])
    assert dict(zip(model.words.to_pylist(), model.word_scores.round(9).tolist(), strict=True)) == {w: round(s, 9) for w, s in words.items()}
    assert {x: round(s, 9) for x, s in zip(model.stems.to_pylist(), model.stem_scores.tolist(), strict=True)} == {x: round(s, 9) for x, s in stems.items() if s}

    def segments(s):  # the best segment, then what is to its left and right
        best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
        if best[0] <= 1e-12:
            return []
        return [*segments(s[: best[3]]), best[0], *segments(s[best[4] :])]

    for r in toxicity.score(docs, model).collect():
        tokens = plain_words(texts.get(r.doc_id, {702: "vile3 vile4 unknown"}.get(r.doc_id)))
        s = [(words[w] if w in words else stems.get(w[: toxicity.STEM], 0.0)) - toxicity.DRIFT for w in tokens]
        evidence = -toxicity.MOST_EVIDENCE
        if s:
            expected = [math.log(model.k * len(s)) - model.lam * x for x in segments(s)]
            firm = [e for e in expected if e <= toxicity.LOG_EXPECTED]
            evidence = -sum(firm) if firm else -min(expected, default=math.log(model.k * len(s)))
            evidence = max(-toxicity.MOST_EVIDENCE, min(toxicity.MOST_EVIDENCE, evidence))
            assert len(r.passages) == len(firm)
        assert abs(r.score - 1 / (1 + math.exp(-(model.slope * evidence + model.offset)))) < 1e-6, r.doc_id


# language


def plain_vector(text):
    """A text's vector, letter by letter."""
    a, b, c = langid.letter_vectors()
    table, symbols = langid.symbol_table(), [0]
    for ch in text:
        x = int(table[ord(ch)])
        if x or symbols[-1]:
            symbols.append(x)
    if symbols[-1]:
        symbols.append(0)
    total = np.zeros(langid.DIMENSIONS)
    for x, y, z in zip(symbols, symbols[1:], symbols[2:], strict=False):
        if y:
            total += a[x].astype(int) * b[y] * c[z]
    return total


@pytest.mark.parametrize("piece", [1, 3, 1 << 20])
def test_vectors_match_loops(piece, monkeypatch):
    for text in ("", " ", "a", " Ab c!!dé 漢字 ", "x" * 10, "  the quick, brown  fox. ", "ힰ \U00032000 z", "12 3"):
        codes = np.concatenate(list(langid.trigrams(text, piece)))
        a, b, c = langid.letter_vectors()
        n = langid.SYMBOLS
        found = (a[codes // n // n].astype(int) * b[codes // n % n] * c[codes % n]).sum(axis=0)
        assert (found == plain_vector(text)).all()
        if piece > 100:
            v = langid.bundle(text)
            assert (v is None) == (not any(map(str.isalpha, text))) and (v is None or (v == plain_vector(text)).all())


def test_prototypes_match_a_plain_version(spark):
    rnd = random.Random(4)
    alphabets = {"aa": "aeiourst", "bb": "kzwxyqjp", "cc": "абвгдежз"}
    rows = [(i, " ".join("".join(rnd.choices(alphabets[lang], k=rnd.randint(2, 7))) for _ in range(12)), lang) for i, lang in enumerate(rnd.choices(list(alphabets), k=90))]
    docs = spark.createDataFrame([*rows, (None, "not learned", "dd"), (200, None, "aa"), (201, "no lang", None)], "doc_id long, text string, lang string")
    profiles = langid.fit(docs)
    sums = {}
    for i, text, lang in rows:
        if not held(i):
            v = plain_vector(text)
            sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
    protos = np.array([sums[x] / np.linalg.norm(sums[x]) for x in sorted(sums)])
    shared = protos.mean(axis=0) / np.linalg.norm(protos.mean(axis=0))
    protos = protos - np.outer(protos @ shared, shared)
    protos /= np.linalg.norm(protos, axis=1, keepdims=True)
    assert profiles.langs == sorted(sums) and np.abs(profiles.prototypes - protos).max() < 1e-4
    for r in langid.identify(docs, profiles).filter("doc_id is not null").collect():
        text = next((t for i, t, _ in rows if i == r.doc_id), {201: "no lang"}.get(r.doc_id))
        if text is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        v = plain_vector(text)
        v = v - (v @ shared) * shared
        cosines = protos @ v / np.linalg.norm(v)
        assert r.lang_pred == profiles.langs[int(np.argmax(cosines))] and abs(r.score - max(0, cosines.max())) < 1e-3


# quality


def test_normal_equations_match_least_squares(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float)
    rows = [(float(b), int(i % quality.FOLDS), a.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    model = quality._solve(spark.createDataFrame(rows, "label double, fold int, stats array<double>").repartition(3))
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    f = quality.fourier(z)
    penalty = np.sqrt(np.array([quality.RIDGE] * quality.FEATURES + [1e-6]))
    solve = lambda f, y: np.linalg.lstsq(np.vstack([f, np.diag(penalty)]), np.concatenate([y, np.zeros(len(penalty))]), rcond=None)[0]
    assert np.abs(model.weights - solve(f, y)).max() < 1e-6
    fold = np.arange(len(y)) % quality.FOLDS
    unseen = np.concatenate([f[fold == k] @ solve(f[fold != k], y[fold != k]) for k in range(quality.FOLDS)])
    at, value = quality.isotonic(unseen, np.concatenate([y[fold == k] for k in range(quality.FOLDS)]))
    assert np.abs(model.steps_x - at).max() < 1e-6 and np.abs(model.steps_y - value).max() < 1e-9


def test_kernel_is_approximated():
    rng = np.random.default_rng(6)
    z = rng.normal(size=(40, len(quality.STATISTICS))) * 0.7
    f = quality.fourier(z)[:, :-1]
    kernel = np.exp(-((z[:, None] - z[None]) ** 2).sum(axis=2) / (2 * quality.WIDTH**2))
    assert np.abs(f @ f.T - kernel).max() < 0.25 and np.abs(f @ f.T - kernel).mean() < 0.05


def test_isotonic_matches_the_minimax_formula():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 30):
        x, y = rng.permutation(n).astype(float), rng.integers(0, 2, n).astype(float)
        y0 = y[np.argsort(x)]
        exact = [max(min(y0[a : b + 1].mean() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        at, value = quality.isotonic(x, y)
        steps = np.array(sorted(set(np.round(exact, 9))))
        assert np.allclose(np.unique(np.round(value, 9)), steps)
        bounds = [np.flatnonzero(np.isclose(exact, v)) for v in steps]
        assert np.allclose(sorted(set(np.round(value, 9))), [exact[b[0]] for b in bounds]) and (np.diff(at) > 0).all()


# near duplicates


def test_least_shared_is_a_bound():
    """What sets of any sizes that link share of their extended prefixes, at the worst placing of what they don't share."""
    for n in range(1, 260):
        for m in range(-(-80 * n // 100), n * 100 // 80 + 1):
            overlap = -(-80 * (n + m) // 180)
            first = min(neardup.extended_size(k) - (k - overlap) for k in (n, m))
            assert first >= neardup.least_shared(n), (n, m)


def test_prefix_counts_drop_no_link(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(400):
        if i % 5 == 0 or not rows:
            words = [f"v{rnd.randint(0, 3000)}" for _ in range(rnd.choice([3, 7, 12, 33, 60, 200]))]
        else:
            words = rnd.choice(rows)[1].split()
            for _ in range(max(1, round(len(words) * rnd.choice([0.005, 0.02, 0.03, 0.05])))):
                words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    want = brute_components(rows)
    assert len({c for *_, c in want}) < 370 and sorted(map(tuple, found), key=str) == want


def test_sets_of_one_name_get_new_names(spark, monkeypatch):
    sets = spark.createDataFrame([(1, 3, 7, 1), (2, 3, 7, 2), (3, 3, 7, 1), (4, 3, 8, 1), (5, 0, 0, 0)], "doc_id long, n long, node long, check long")
    renamed = neardup.renamed_sets(sets)
    assert list(renamed) == [(7, 2)] and renamed[7, 2] not in (7, 8)


# the registered queries


@pytest.mark.parametrize("name", ["op1_toxicity", "op6_quality"])
def test_classifier_queries(name, spark, sf):
    rows = queries.QUERIES[name](spark, sf).collect()
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(r.doc_id for r in rows) == ids
    edge = 0.7 if name == "op1_toxicity" else 0.5
    assert all(r.held_out is held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= edge) for r in rows)


def test_language_query(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op3_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        lettered = bool(docs[r.doc_id].text) and any(map(str.isalpha, docs[r.doc_id].text))
        assert r.held_out is held(r.doc_id) and (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
    assert {r.lang_pred for r in rows} - {"und"} <= {d.lang for d in docs.values()}


def test_near_duplicate_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = queries.op2_ngram_jaccard(spark, sf).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, rows), key=str) == brute_components(docs)


def test_token_count_query(spark, sf):
    from obsidio.llm import tokencount

    using = tokencount.counter()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op4_token_counts(spark, sf).collect():
        text = docs[r.doc_id]
        n = len(text)
        for at, deleted, inserted in ((n // 3, 9, " [masked] "), (2 * n // 3, 17, ""), (0, 0, "Title: "), (n // 2, 0, "\n")):
            at = min(at, len(text))
            text = text[:at] + inserted + text[at + deleted :]
        assert (r.n_tokens_before, r.n_tokens) == tuple(len(using.encoding.encode_ordinary(t)) for t in (docs[r.doc_id], text))


def test_mixing_query(spark, sf):
    from .test_operators import deviations

    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op7_pfair_mixing(spark, sf).collect()
    assert {r.doc_id: r.source for r in rows} == docs and len({r.position for r in rows}) == len(rows)
    slots = {r.slot: r.source for r in rows}
    sizes = collections.Counter(docs.values())
    assert deviations([slots[k] for k in range(len(slots))], {s: n**0.5 for s, n in sizes.items()}) < 1


def test_bpe_query(spark, sf):
    from obsidio.llm import bpe
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    library.no_truncation(), library.no_padding()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op10_bpe_automaton(spark, sf).collect()}
    assert rows.keys() == docs.keys()
    for i, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(rows[i])[1:] == (len(ids), digest(" ".join(map(str, ids))), digest(decoded))


def test_pipeline_query(spark, sf):
    import __spark_entry__

    rows = __spark_entry__.queries()["pipeline"](spark, sf)
    assert {"doc_id", "n_tokens", "ids", "source", "slot", "position"} <= set(rows.columns) and rows.select(F.count_distinct("doc_id")).first()[0] == rows.count() > 0
