"""Passages, whitening, line dedup and lexical search against brute force, with every awkward case."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import ROWS, prose

from reviewlens.llm import lexical, lines, paragraphs, passages, whitening


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(i, t, 7, 1, "z") for i, t in ROWS], "doc_id bigint, text string, term int, rank int, kept string"
    )


# passages


def shared_runs(texts, size):
    """The words of each text that lie in ``size`` words found in two places that do not overlap."""
    runs = defaultdict(list)
    for i, words in enumerate(texts):
        for a in range(len(words) - size + 1):
            runs[tuple(words[a : a + size])].append((i, a))
    covered = [set() for _ in texts]
    for places in runs.values():
        at = [a for _, a in places]
        if len({i for i, _ in places}) > 1 or max(at) - min(at) >= size:
            for i, a in places:
                covered[i].update(range(a, a + size))
    return covered


def passage_corpus():
    rnd = random.Random(31)
    words = [f"w{n}" for n in range(4000)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    inside, lines_, whole, almost = text(59), [text(6) for _ in range(12)], text(300).split(), text(49)
    rows = [(i, text(rnd.randint(1, 400))) for i in range(40)]
    rows += [(100 + i, f"{text(rnd.randint(0, 70))} {inside} {text(rnd.randint(0, 70))}") for i in range(6)]  # inside one long line
    rows += [(110 + i, text(9) + "\n" + ("\n" * (i + 1)).join(lines_) + "\n" + text(20)) for i in range(3)]  # across short lines
    rows += [(120 + i, " ".join([*whole[: 90 + i], "changed", *whole[91 + i :]])) for i in range(4)]
    rows += [(130 + i, f"{text(60)} {almost} {text(60)}") for i in range(3)]  # one word too short
    rows += [(140, f"{inside} {text(30)} {inside}"), (150, None), (151, ""), (152, "one two"), (153, "ha " * 500), (None, text(30) + " " + inside)]
    rows += [(160, inside.replace(" ", "\t \n")), (160, inside.replace(" ", "\t \n")), (161, "é" * 400), (162, "中文 🙂 " * 90)]
    return rows


def test_passages_cover_every_shared_run_and_leave_the_rest(spark):
    rows = passage_corpus()
    table = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id bigint, text string, row int, piece int, begin int")
    found = passages.repeated_passages(table).persist()
    ranges = defaultdict(set)
    for r in passages.merged_ranges(found).collect():
        assert r.n_words >= 50 and 0 <= r.removed_words <= r.n_words
        ranges[r.doc_id].update(range(r.first_word, r.first_word + r.n_words))
    given = list(dict.fromkeys(rows))
    words = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for _, t in given]
    for (i, _), covered in zip(given, shared_runs(words, 50), strict=True):
        assert covered <= ranges[i], i
        if not covered:
            assert not ranges[i], i
    assert {100, 105, 110, 112, 120, 123, 140, 160, None} <= set(ranges) and not {130, 131, 132} & {i for i, r in ranges.items() if r}
    # Of the exact copies, one document keeps the passage; the others lose all of it.
    gone = defaultdict(set)
    for r in found.filter("removed").collect():
        gone[r.doc_id].update(range(r.first_word, r.first_word + r.n_words))
    kept = [i for (i, _), covered in zip(given, shared_runs(words, 50), strict=True) if covered and not gone[i]]
    assert kept.count(None) == 1 and not {101, 102, 103, 104, 105, 160} & set(kept)
    assert passages.repeated_passages(table.filter("false")).count() == 0


def test_near_copies_of_pieces_are_linked(spark):
    rnd = random.Random(5)
    base = [f"v{rnd.randrange(9000)}" for _ in range(400)]
    changed = list(base)
    for at in range(30, 400, 45):  # no 50 words in a row stay equal
        changed[at] = f"other{at}"
    table = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(changed)), (3, " ".join(reversed(base)))], "doc_id int, text string")
    found = {r.doc_id: r for r in passages.merged_ranges(passages.repeated_passages(table)).collect()}
    assert set(found) == {1, 2} and found[2].removed_words > 0 and found[1].removed_words == 0


def test_pieces_of_all_anchors_are_compared(spark):
    """Before, only sparse anchors had pieces: most near copies of about 100 words in other surroundings were missed."""
    rnd = random.Random(77)
    text = lambda n: [f"q{rnd.randrange(50000)}" for _ in range(n)]
    rows = []
    for n in range(30):
        passage = text(99)  # with one word changed, 49 equal words on either side
        for k in range(2):
            own = passage if k else [*passage[:49], "changed", *passage[50:]]
            rows.append((2 * n + k, " ".join([*text(rnd.randint(60, 160)), *own, *text(rnd.randint(60, 160))])))
    almost = text(49)
    rows += [(100 + n, " ".join([*text(90), *almost, *text(90)])) for n in range(12)] + [(200 + n, " ".join(text(300))) for n in range(5)]
    found = {r.doc_id: r for r in passages.merged_ranges(passages.repeated_passages(spark.createDataFrame(rows, "doc_id int, text string"))).collect()}
    assert set(found) <= set(range(60)) and len(found) >= 56
    assert all(found[i].removed_words > 0 and found[i - 1].removed_words == 0 for i in found if i % 2)


def test_buckets_of_the_same_pieces_are_compared_once(spark):
    """Before, a pair of pieces was compared in every band in which it met."""
    held = {1: [10, 11], 2: [10, 11], 3: [11, 12], 4: [10, 11, 12], 5: [12, 10, 11], 6: [13], 7: [10, 12], 8: [-1, 2**63 - 1], 9: [2**63 - 1, -1]}
    banded = spark.createDataFrame([(k, p) for k, own in held.items() for p in own], "key bigint, para bigint")
    found = passages.different_buckets(banded).collect()
    assert {(r.key, r.n) for r in found} == {(1, 2), (3, 2), (4, 3), (7, 2), (8, 2)}
    assert sorted((r.key, r.para) for r in found) == sorted((k, p) for k in (1, 3, 4, 7, 8) for p in held[k])


def test_shingle_sets_equal_sets_of_shingles():
    rnd = random.Random(2)
    texts = [" ".join(f"é{rnd.randrange(5)}" for _ in range(rnd.randint(1, 60))) for _ in range(300)] + ["", "a", "a b"]
    for width in (1, 2, 5):
        plain = [frozenset(paragraphs.shingles(t.split(" "), width)) for t in texts]
        hashed = paragraphs.shingle_sets(pa.array(texts, pa.string()), width)
        for i in range(len(texts)):
            for j in range(0, i, 7):
                if min(len(texts[i].split(" ")), len(texts[j].split(" "))) >= width or texts[i] == texts[j]:
                    assert len(plain[i] & plain[j]) == len(hashed[i] & hashed[j])
        assert list(map(len, plain)) == list(map(len, hashed))
    assert paragraphs.shingle_sets(pa.array([], pa.string()), 5) == []


def test_pieces_are_alike_whatever_surrounds_them():
    rnd = random.Random(9)
    shared = [f"s{i}" for i in range(50)]
    cores = []
    for _ in range(40):
        before, after = ([f"x{rnd.random()}" for _ in range(rnd.randint(0, 90))] for _ in range(2))
        own = passages.Pieces([" ".join([*before, *shared, *after]).encode()], passages.WordHashes(), 50, 5, 25)
        at = own.at - own.offset
        inside = (at >= len(before)) & (at + 25 <= len(before) + 50)
        cores.append(set(own.core[inside].tolist()))
    assert set.intersection(*cores)
    assert all(passages.sliding_minimum(np.array([3, 1, 4, 1, 5, 9, 2, 6]), n).tolist()
               == [min(([3, 1, 4, 1, 5, 9, 2, 6])[i : i + n]) for i in range(9 - n)] for n in range(1, 9))


def test_line_paragraphs_find_short_lines(spark):
    """The operator on whole lines, with lines of any length."""
    rnd = random.Random(12)
    short = [prose(rnd, n) for n in range(1, 20)]
    table = spark.createDataFrame([(0, "\n".join(short)), (1, "\n\n".join(f" {s} \t" for s in short))], "doc_id bigint, text string")
    found = {(r.doc_id, r.paragraph) for r in paragraphs.repeated_paragraphs(table, min_words=1).collect()}
    assert {(0, k) for k in range(19)} <= found


# whitening


def whitened_by_force(vectors, k):
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], float)
    centred = x - x.mean(axis=0)
    value, vector = np.linalg.eigh(centred.T @ centred / len(x))
    value, vector = value[::-1], vector[:, ::-1]
    use = [i for i in range(min(k, x.shape[1])) if value[i] > 1e-9 * value[0]]
    return centred @ vector[:, use] / np.sqrt(value[use]), value[use] / value.sum()


def awkward_vectors(d, n, seed):
    rng = np.random.default_rng(seed)
    scale = np.geomspace(40, 0.5, d)
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=d) * scale)]) for i in range(n)]
    return rows


@pytest.mark.parametrize("d", [3, 20, 90])
def test_whitening_equals_a_full_eigenvalue_problem(spark, d):
    rows = awkward_vectors(d, 300, d)
    good = [*rows, rows[5], (None, rows[7][1])]
    bad = [(900, None), (901, []), (902, [1.0] * (d - 1)), (903, [float("nan")] * d), (904, [None] * d), (905, [float("inf")] * d), (906, [1e30] * d)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in good + bad], "vec_id bigint, embedding array<float>, component int, x int")
    out = whitening.whiten(table).collect()
    expected, share = whitened_by_force([v for _, v in good], 8)
    k = min(8, d)
    assert len(out) == k * len(good) and {r.n for r in out} == {len(good)}
    assert max(r.identity_error for r in out) < 1e-9 and len({r.identity_error for r in out}) == 1
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good], object)
    far = dict(zip([i for i, _ in good], ((len(good) * x - x.sum(axis=0)) ** 2).sum(axis=1), strict=True))
    found = {(r.vec_id, r.component): r for r in out}
    place = {i: at for at, (i, _) in enumerate(good)}
    signs = [np.sign(found[0, c + 1].whitened * expected[0, c]) for c in range(k)]
    for (i, c), r in found.items():
        assert r.deviation == far[i]
        assert abs(r.whitened * signs[c - 1] - expected[place[i], c - 1]) < 1e-7
        assert abs(r.explained / share[c - 1] - 1) < 1e-9


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], schema)
    assert whitening.whiten(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 0) for i in range(50)], schema)
    out = whitening.whiten(line).collect()
    assert {r.component for r in out} == {1} and abs(sum(r.whitened**2 for r in out) / 50 - 1) < 1e-9


def test_exact_deviations_beyond_a_double():
    block = np.array([[10**6 + 1, -5], [3, 10**6]])
    sums = np.array([123456, -98765])
    for n in (7, 2500):
        exact = [sum((n * int(x) - int(s)) ** 2 for x, s in zip(row, sums, strict=True)) for row in block]
        assert whitening.deviations(block, n, sums) == exact
    assert whitening.deviations(np.array([[1 << 40, 0]]), 1 << 20, sums) == [None]


def test_subspace_iteration_on_hard_spectra():
    rng = np.random.default_rng(3)
    for spectrum in (np.ones(60), np.r_[np.full(30, 2.0), np.ones(30)], np.geomspace(1e9, 1e-3, 120), np.linspace(1.001, 1, 100)):
        q, _ = np.linalg.qr(rng.standard_normal((len(spectrum),) * 2))
        v = (q * spectrum) @ q.T
        value, vectors = whitening.leading(lambda b, v=v: v @ b, len(spectrum), 8, 1e-12)
        assert np.allclose(value, np.sort(spectrum)[::-1][:8], rtol=1e-9)
        assert np.linalg.norm(v @ vectors - vectors * value) < 1e-10 * spectrum.max()
        assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)


# lines


def without_lines_by_force(rows, least, min_docs):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    name = lambda i: (i is None, i)
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(name(i))
    drop = {k: min(v) for k, v in held.items() if len(k) >= least and len(v) >= min_docs}
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if drop.get(key(x), name(i)) == name(i)]
        yield i, len(own), len(own) - len(kept), "\n".join(kept)


@pytest.mark.parametrize(("shard", "probes", "min_docs"), [(1 << 16, 1 << 18, 2), (4, 3, 2), (16, 5, 3)])
def test_line_dedup_equals_brute_force(spark, monkeypatch, shard, probes, min_docs):
    monkeypatch.setattr(lines, "SHARD", shard)
    monkeypatch.setattr(lines, "PROBES", probes)
    rnd = random.Random(3)
    common = [prose(rnd, 5) for _ in range(6)] + ["short", " \t ", "tenletters", "ninechars"]
    rows = [(i, "\n".join(rnd.choice(common).upper() if rnd.random() < 0.3 else f" {rnd.choice(common)}\r" for _ in range(rnd.randint(1, 9)))) for i in range(60)]
    rows += [(70, "É" * 10), (71, "é" * 10), (72, "É" * 10 + "\n"), (73, None), (74, ""), (75, "\n\n"), (None, common[0]), (None, common[0] + "\nonly here 1")]
    rows += [rows[3], (5, common[1] + "\nanother text of five"), (80, "\n".join([common[2]] * 3000)), (90, "x" * 200_000 + "\n" + common[3])]
    table = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id bigint, text string, line int, key int, shard int")
    out = lines.without_repeated_lines(table, min_docs=min_docs)
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, without_lines_by_force(rows, 10, min_docs)))
    assert lines.without_repeated_lines(table.filter("false")).count() == 0


def test_perfect_hash_numbers_every_key_once():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        a, b = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
        if n > 2:
            a[: n // 2] = a[0]  # half of the keys share one of their hashes
        table = lines.PerfectHash.of(a, b)
        assert sorted(table.number(a, b).tolist()) == list(range(n))
        assert len(table.bits) <= max(4 * n, 64 * 30)


# lexical search


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked_by_force(items, rows, k):
    counts = [(i, Counter(terms(t))) for i, t in rows]
    counts = [(i, c) for i, c in counts if c]
    n_rows, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n_rows) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_rows + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m))
                for w in terms(text) if w in c
            )
            if score > 0 and i is not None:
                scores.append((-score, i))
        for rank, (score, i) in enumerate(sorted(scores)[:k], 1):
            yield item, rank, i, -score


def test_lexical_search_equals_all_scores(spark, docs, monkeypatch):
    rnd = random.Random(17)
    items = [(n, prose(rnd, rnd.randint(1, 25))) for n in range(40)]
    items += [(50 + n, ROWS[n][1]) for n in range(0, len(ROWS), 3) if ROWS[n][1] and len(ROWS[n][1]) < 3000]
    items += [(80, None), (81, ""), (82, "zzz unknown"), (83, "ALPHA alpha Alpha"), (83, "beta 中文🙂"), (0, items[0][1]), (None, "gamma delta")]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    expected = sorted(map(repr, ranked_by_force(items, ROWS, 5)))
    for shard, block, fan, leaf in ((16_384, 8_192, 8, 32), (7, 10, 2, 2), (20, 100, 3, 1)):
        monkeypatch.setattr(lexical, "FAN", fan)
        monkeypatch.setattr(lexical, "LEAF", leaf)
        out = lexical.search_items(table, docs, k=5, shard=shard, block=block)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(repr, map(tuple, out.collect()))) == expected
    assert lexical.search_items(table.filter("false"), docs).count() == 0
    assert lexical.search_items(table, docs.filter("false")).count() == 0


def test_bounds_prune_whole_batches():
    rng = np.random.default_rng(4)
    topics = 40

    def vectors(n, per):
        rows = [np.unique(rng.integers(0, 25, per) + 25 * rng.integers(topics)) for _ in range(n)]
        return lexical.Vectors(np.cumsum([0, *map(len, rows)]), np.concatenate(rows), rng.integers(1, 1000, sum(map(len, rows))))

    asked, held = vectors(64, 8), vectors(4000, 12)
    items = lexical.Items(asked, np.zeros(64, np.int64), 3)
    lexical.search(items, held, np.arange(4000), 25 * topics)
    dense = np.zeros((64, 25 * topics), np.int64)
    dense[np.repeat(np.arange(64), np.diff(asked.start)), asked.term] = asked.value
    other = np.zeros((4000, 25 * topics), np.int64)
    other[np.repeat(np.arange(4000), np.diff(held.start)), held.term] = held.value
    scores = dense @ other.T
    for place, item in enumerate(items.order):
        best = sorted((-s, i) for i, s in enumerate(scores[item]) if s > 0)[:3]
        assert [(-s, d) for s, d in zip(items.score[place], items.doc[place], strict=True) if s > 0] == best
    assert items.pairs < 64 * 4000 / 8  # node pairs looked at, against all pairs of rows


def test_hashes_in_hex_are_of_the_kept_text(spark):
    table = spark.createDataFrame([(1, "A\nB is a long line"), (2, "b is a long line ")], "doc_id bigint, text string")
    out = lines.without_repeated_lines(table).select("doc_id", F.sha2(F.col("kept").cast("binary"), 256).alias("h"))
    assert {r.doc_id: r.h for r in out.collect()} == {
        1: hashlib.sha256(b"A\nB is a long line").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
