"""Each operator against brute force, over awkward rows and a whole small table."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.llm import brute
from tidemark.llm import (
    ann,
    decontaminate,
    language,
    licenses,
    line_dedup,
    packing,
    pii,
    simhash,
    suffix_dedup,
    token_counts,
)
from tidemark.llm.queries import tokenizer

PIECES, BYTES = tokenizer("piece_bpe_32k.model"), tokenizer("word_bpe_49k.json")


def tuples(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# --- 1: suffix dedup ------------------------------------------------------------------------


def _spans(df, given):
    """Spans per distinct row, as the operator names rows: by doc_id and text."""
    hashes = df.sparkSession.createDataFrame([(d, t or "", n) for n, (d, t) in enumerate(given)], "d long, t string, n int")
    keys = {(r.d, r.h): r.n for r in hashes.select("d", "n", F.xxhash64("t").alias("h")).collect()}
    out: dict = {}
    for r in df.collect():
        out.setdefault(keys[r.doc_id, r.text_hash], []).append((r.start_word, r.end_word))
    return {n: sorted(s) for n, s in out.items()}


def _expected(given):
    last = {(d, t or ""): n for n, (d, t) in enumerate(given)}
    return {n: s for n, s in brute.passages(given).items() if n in last.values()}


def test_passages_of_awkward_rows(docs, rows):
    assert _spans(suffix_dedup.repeated_passages(docs), rows) == _expected(rows)


def test_passages_of_documents(documents, listed):
    found = _spans(suffix_dedup.repeated_passages(documents), listed)
    assert found and found == _expected(listed)


def test_a_match_between_two_better_neighbours_is_found(spark):
    """Three texts share a core with the fourth: one more to the left, one more to the right, one enough of both."""
    rng = np.random.default_rng(1)
    words = lambda n: [f"w{rng.integers(10**9)}" for _ in range(n)]
    for left, right in ((12, 13), (6, 18), (20, 5)):
        core, a, b = words(27), words(left), words(right)
        texts = [
            words(40) + a + core + b + words(40),  # the passage
            words(40) + a + core + b + words(40),
            words(40) + core + b + words(60),
            words(60) + a + core + words(40),
            words(60) + core + words(60),
        ]
        given = [(n, " ".join(t)) for n, t in enumerate(texts)]
        df = spark.createDataFrame(given, "doc_id long, text string")
        assert _spans(suffix_dedup.repeated_passages(df), given) == _expected(given)


def test_passages_in_sorted_parts(spark, documents, listed):
    """Cores split over many parts of the sort."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _spans(suffix_dedup.repeated_passages(documents), listed) == _expected(listed)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_removed_repeats_leave_one_copy(docs, rows):
    left = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(docs).where("doc_id in (9, 10, 11, 23, 5, 6)").collect()}
    shared = dict((d, t) for d, t in rows if d is not None)[23]
    assert shared in left[9] and shared not in left[10] + left[11] + left[23]
    assert brute.words(left[6]) == [] and len(brute.words(left[5])) == 120


def _shortened(given, least=50):
    """Words of each text left without the windows an earlier document has too."""
    first: dict = {}
    own = [brute.words(t) for _, t in given]
    windows = [[tuple(w[k : k + least]) for k in range(len(w) - least + 1)] for w in own]
    for (d, _), found in zip(given, windows):
        for w in found if d is not None else ():
            first[w] = min(d, first.get(w, d))
    out = Counter()
    for (d, _), w, found in zip(given, own, windows):
        gone = {k + n for k, x in enumerate(found) if first.get(x, d) != d for n in range(least)}
        out[d, tuple(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


def _left(df):
    return Counter((r.doc_id, tuple(brute.words(r.text))) for r in suffix_dedup.remove_repeats(df).collect())


@pytest.mark.parametrize("name", ["docs", "documents"])
def test_removed_repeats_are_those_an_earlier_document_has(request, name, rows, listed):
    assert _left(request.getfixturevalue(name)) == _shortened(rows if name == "docs" else listed)


def test_no_word_is_lost_to_all(spark):
    """A core that many contexts share, and matches with earlier and later documents that overlap."""
    rng = np.random.default_rng(6)
    words = lambda n: [f"w{rng.integers(10**9)}" for _ in range(n)]
    core, left, right, chain = words(30), words(15), words(15), words(150)
    texts = {
        1: words(40) + core + words(40), 3: words(40) + core + words(40),
        5: words(40) + left + core + right + words(40), 7: words(60) + left + core + right + words(20),
        9: words(30) + chain[:60] + words(30), 11: words(30) + chain[5:110] + words(30), 13: words(30) + chain[40:] + words(30), 15: chain,
    }
    given = [(d, " ".join(t)) for d, t in texts.items()]
    found = _left(spark.createDataFrame(given, "doc_id long, text string"))
    assert found == _shortened(given)
    kept = {d: set(w) for d, w in found}
    assert {*left, *core, *right} <= kept[5] and not kept[7] & {*left, *core, *right}
    assert set().union(*texts.values()) == set().union(*kept.values())


def test_the_removal_is_registered(spark, sf_dir, listed):
    found = driver.queries()["op1_shortened_texts"](spark, sf_dir)
    assert Counter((r.doc_id, tuple(brute.words(r.text))) for r in found.collect()) == _shortened(listed)


# --- 2: personal data -----------------------------------------------------------------------


@pytest.mark.parametrize("name", ["docs", "documents"])
def test_base_spans(request, name, rows, listed):
    given = rows if name == "docs" else listed
    found = pii.find_personal_data(request.getfixturevalue(name))
    expected = Counter()
    for doc, text in given:
        counts, digest = brute.personal(text)
        expected[(doc, *(counts[k] for k in pii.BASE), digest)] += 1
    assert tuples(found, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == expected


def test_all_spans_hold_the_base_and_are_text(docs, rows):
    texts = dict((d, t) for d, t in rows)
    for r in pii.find_personal_data(docs).collect():
        kinds = [s.split(":") for s in r.spans.split(",") if s]
        assert [k for k, _, _ in kinds] == sorted((k for k, _, _ in kinds), key=pii.KINDS.index)
        assert len(kinds) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
        assert all(0 <= int(s) < int(e) <= len(texts[r.doc_id]) for _, s, e in kinds)


def test_secrets_are_found_and_words_are_not(spark):
    rng = np.random.default_rng(5)
    digits = lambda letters, n: "".join(rng.choice(list(letters), n))
    secret = [f'token = "{digits("0123456789abcdef", 40)}"' for _ in range(40)]
    plain = [f"see internationalisation{n} and order 4{digits('0123456789', 12)}" for n in range(40)]
    given = [(n, f"{t} mail a{n}@example.com or +1 (555) 555-{1000 + n}") for n, t in enumerate(secret + plain)]
    found = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    texts = dict(given)
    added = {d: [texts[d][int(s) : int(e)] for k, s, e in (x.split(":") for x in spans.split(",")) if k == "secret"] for d, spans in found.items()}
    assert all(added[n] == [secret[n][9:-1]] for n in range(40)) and not any(added[n] for n in range(40, 80))


def test_reliabilities_of_planted_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.6
    right = (0.95, 0.8, 0.6)
    ballots = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in right], axis=1)
    seen = np.concatenate([np.zeros((4000, 2), int), ballots], axis=1)
    patterns, weight = np.unique(seen, axis=0, return_counts=True)
    likely, rates = pii.expectation_maximisation(patterns, weight.astype(float))
    assert [round(float(r), 1) for r in rates[1, :, 2]] == [round(p, 1) for p in (0.95, 0.8, 0.6)]
    index = {tuple(p): k for k, p in enumerate(patterns.tolist())}
    guess = np.array([likely[index[tuple(s)]] > 0.5 for s in seen.tolist()])
    assert (guess == truth).mean() > 0.93


def test_masked_text_has_no_base_span(docs):
    for r in pii.mask(docs).collect():
        assert sum(brute.personal(r.text)[0].values()) == 0


# --- 3: line dedup --------------------------------------------------------------------------


@pytest.mark.parametrize("sites", [2, 3, 8])
def test_lines(spark, sites):
    common = [f"boilerplate {n}" for n in range(12)]
    given = [(d, f"s{d % (1 + n)}", f"own {d}\n{line}\n\n{line}") for n, line in enumerate(common) for d in range(n, 40)]
    given += [(None, "s1", "boilerplate 11\nx"), (None, "s9", "only\nnobody"), (77, None, None), (78, None, ""), (79, "s3", " \n \n"), (5, "s0", given[0][2])]
    given += [given[3], given[3]]
    df = spark.createDataFrame(given, "doc_id long, source string, text string").withColumn("line", F.lit(1)).withColumn("at", F.lit(2))
    found = line_dedup.remove_boilerplate(df, min_sites=sites)
    assert tuples(found, "doc_id", "n_lines", "n_removed", "text") == Counter(brute.lines(given, sites))


def test_near_threshold_counts_are_exact(spark):
    """With coarse sketches every line near the threshold is counted again."""
    given = [(d, f"s{d}", f"line {n}") for n in range(40, 60) for d in range(n)]
    df = spark.createDataFrame(given, "doc_id long, source string, text string")
    found = line_dedup.remove_boilerplate(df, min_sites=50, log_k=6)
    assert tuples(found, "doc_id", "n_lines", "n_removed", "text") == Counter(brute.lines(given, 50))


# --- 4: decontamination ---------------------------------------------------------------------

ITEMS = [(1, "one"), (2, None), (3, ""), (None, "wide"), (4, "12 + 34 = 46"), (4, "nobody's text"), (10, "a a a a a a a a a a a a"), (11, "nobody's text")]


@pytest.mark.parametrize("block_bytes", [32_000_000, 40])
@pytest.mark.parametrize("shard_bytes", [4_000_000, 200])
def test_contamination_of_awkward_rows(spark, docs, rows, block_bytes, shard_bytes):
    passage = " ".join(brute.words(rows[12][1])[500:530])
    items = [*ITEMS, (20, passage), (21, passage.upper().replace(" ", "--") + " tail")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs, benchmark, shard_bytes=shard_bytes, block_bytes=block_bytes)
    assert tuples(found) == Counter(brute.contamination(rows, items))


def test_longest_matches_and_removal(spark, docs, rows):
    own = brute.words(rows[12][1])
    items = [(1, "before " + " ".join(own[1000:1040]) + " after"), (2, " ".join(own[:12]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {tuple(r) for r in decontaminate.longest_matches(docs, benchmark).collect()}
    assert {("1", 1, 13, 1000, 40), ("2", 0, 13, 0, 12)} <= found
    bad = {d for d, *_, hit in brute.contamination(rows, items) if hit}
    kept = decontaminate.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and tuples(kept, "doc_id") == Counter((d,) for d, _ in rows if d not in bad)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(2)
    for n, letters in ((1, 1), (50, 1), (200, 2), (500, 5)):
        word = rng.integers(0, letters, n).astype(np.uint64)
        order = decontaminate.SuffixArray(word, n).order
        suffixes = [tuple(word[k:]) for k in order]
        assert suffixes == sorted(suffixes)


# --- 5: packing -----------------------------------------------------------------------------


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(docs, rows, capacity):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(BYTES)
    found = packing.pack(docs, BYTES, capacity).collect()
    expected = Counter((d, *p) for d, t in rows for p in brute.pieces(t, own, capacity))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    _gapless(found, capacity)


def _gapless(found, capacity):
    sequences: dict = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_of_documents_is_tight(documents):
    found = packing.pack(documents, BYTES).collect()
    least = -(-sum(r.length for r in found) // 2048)
    assert _gapless(found, 2048) <= least + 1


@pytest.mark.parametrize("histogram", [{}, {7: 1}, {10: 5}, {6: 3, 4: 3}, {5: 4, 3: 4, 2: 4}, {9: 2, 8: 3, 1: 1}, {1: 25}])
def test_plan_uses_every_piece_once(histogram):
    used: Counter = Counter()
    for pattern, times in packing.plan(histogram, 10):
        assert sum(pattern) <= 10
        for length in pattern:
            used[length] += times
    assert used == Counter(histogram)


# --- 6: nearest neighbours ------------------------------------------------------------------


def _nearest(vectors, every, k=20):
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids])
    out = {}
    for q in ids:
        if q % every == 0:
            scores = (matrix * np.array(vectors[q])).sum(axis=1)
            out[q] = sorted((-s, i) for s, i in zip(scores.tolist(), ids) if i != q)[:k]
    return out


def test_neighbours_of_the_embeddings(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    known = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    expected = _nearest(known, 20)
    found: dict = {}
    for r in ann.nearest(vectors).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i in e}) for q, e in expected.items())
    assert set(found) == set(expected) and hits >= 0.99 * sum(map(len, expected.values()))
    for q, own in found.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert all(abs(s - float(known[q] @ known[i])) < 1e-12 for _, i, s in own)
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(4)
    given = [(n, [float(x) for x in rng.normal(size=9)]) for n in range(60)]
    given += [(n, given[3][1]) for n in range(60, 100)]  # one vector many times
    odd = [(100, None), (120, [0.0] * 9), (140, [float("nan")] * 9), (160, [1.0, None] + [0.0] * 7), (180, [float("inf")] * 9), (200, []), (220, [1.0]), (None, given[0][1])]
    df = spark.createDataFrame(given + odd + given[:5], "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).repartition(4)
    for blocks in (16_000_000, 200):
        found: dict = {}
        for r in ann.nearest(df, every=20, block_bytes=blocks).collect():
            found.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
        for q, expected in _nearest(dict(given), 20).items():
            own = sorted(found.pop(q))
            assert [i for _, _, i in own] == [i for _, i in expected]
            assert [s for _, s, _ in own] == pytest.approx([s for s, _ in expected])
        assert not found


def test_query_blocks_are_not_kept_in_the_plan(spark):
    """With several blocks the result is read from one stored table: no branch and no block for each."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(n, [float(x) for x in rng.normal(size=9)]) for n in range(400)], "vec_id long, embedding array<double>")
    found = ann.nearest(df, every=20, block_bytes=200)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "InArrow" not in plan and "neighbours-" in found.inputFiles()[0]
    assert tuples(found) == tuples(ann.nearest(df, every=20))


def _outliers(kind: str) -> list[tuple]:
    rng = np.random.default_rng(7)
    given = [(n, rng.normal(size=16)) for n in range(240)]
    if kind == "one large":
        given[7] = (7, np.eye(16)[0] * 1e200)
    elif kind == "one large query":
        given[20] = (20, -np.eye(16)[3] * 1e200)
    elif kind == "overflow":
        given = [(n, v * (1e200 if n % 9 == 0 else 1)) for n, v in given]
    elif kind == "limit":
        given[5] = (5, np.full(16, np.finfo(float).max))
        given[40] = (40, np.full(16, -np.finfo(float).max))
    elif kind == "tiny":
        given = [(n, v * 1e-200) for n, v in given]
    elif kind == "mixed":
        given = [(n, v * 10.0 ** rng.integers(-150, 150)) for n, v in given]
    elif kind == "equal":
        given = [(n, np.full(16, 0.3)) for n, _ in given]
    return given


@pytest.mark.parametrize("kind", ["one large", "one large query", "overflow", "limit", "tiny", "mixed", "equal"])
def test_any_finite_vector(spark, kind):
    """Neither a component of 1e200 nor one of 1e-200 costs another vector its place."""
    given = _outliers(kind)
    df = spark.createDataFrame([(n, v.tolist()) for n, v in given], "vec_id long, embedding array<double>").repartition(3)
    found: dict = {}
    for r in ann.nearest(df).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    with np.errstate(all="ignore"):
        for q, vector in given:
            if q % 20 == 0:
                scores = {i: float((vector * v).sum()) for i, v in given if i != q}
                best = sorted((-s if s == s else np.inf, i) for i, s in scores.items())[:20]
                own = sorted(found.pop(q))
                assert [i for _, i, _ in own] == [i for _, i in best]
                assert [s for _, _, s in own] == pytest.approx([-s for s, _ in best])
    assert not found


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(few).collect()] == [(0, 1, 1, 11.0)]
    assert ann.nearest(few.where("vec_id = 0")).collect() == []
    assert ann.nearest(few.where("1 = 0")).collect() == []


# --- 7: SimHash -----------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["docs", "documents"])
def test_simhash(request, name, rows, listed):
    given = rows if name == "docs" else listed
    prints = [(d, brute.simhash(t)) for d, t in given]
    expected = Counter((d, f"{p:016x}", c) for (d, p), c in zip(prints, brute.components(prints)))
    assert tuples(simhash.near_duplicates(request.getfixturevalue(name)), "doc_id", "fingerprint", "component_id") == expected


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_join_what_all_pairs_join(spark, bits):
    rng = np.random.default_rng(bits)
    seeds = rng.integers(0, 1 << 62, 6)
    values = sorted({int(s) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5))) for s in seeds for _ in range(12)})
    prints = [(v, v) for v in values]
    signed = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(signed, bits)).collect()}
    groups: dict = {}
    for v in values:
        groups.setdefault(found.get(simhash._signed(v), simhash._signed(v)), []).append(v)
    expected: dict = {}
    for v, c in zip(values, brute.components(prints, bits)):
        expected.setdefault(c, []).append(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(200)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_one_of_each_group_stays(docs, rows):
    kept = simhash.keep_one(docs)
    prints = [(d, brute.simhash(t)) for d, t in rows if d is not None]
    expected = Counter({d for (d, _), c in zip(prints, brute.components(prints)) if d == c}) + Counter(d for d, _ in rows if d is None)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == expected


# --- 8: token counts ------------------------------------------------------------------------


@pytest.mark.parametrize("head", [token_counts.HEAD, 50, 0])
def test_token_counts(docs, rows, head):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = Counter()
    for doc, text in rows:
        n = len(model.encode(text or ""))
        expected[doc, len((text or "").encode()), n, n > 4096] += 1
    assert tuples(token_counts.token_counts(docs, PIECES, head=head)) == expected


def test_token_counts_of_documents(documents, listed):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = [len(ids) for ids in model.encode([t for _, t in listed])]
    found = tuples(token_counts.token_counts(documents, PIECES), "doc_id", "n_tokens")
    assert found == Counter(zip([d for d, _ in listed], counts))


# --- 9: licenses ----------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["docs", "documents"])
def test_licenses(request, name, rows, listed):
    given = rows if name == "docs" else listed
    found = licenses.license_scan(request.getfixturevalue(name))
    expected = Counter((d, *brute.licenses(t)) for d, t in given)
    assert tuples(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == expected
    for r in found.collect():
        assert 0 <= r.score <= 1 and {*r.base_labels.split(",")} <= {"", *r.labels.split(",")}


def test_changed_notices_are_found(spark):
    notice = next(n for n, label in licenses.NOTICES.items() if label == "bsd")
    words = notice.split()
    changed = " ".join([*words[:6], "really", *words[6:12], *words[13:]])
    given = [(1, f"pre {notice} post"), (2, changed), (3, " ".join(words[:8])), (4, " ".join(reversed(words))), (5, "Licensed under CC BY-NC 4.0.")]
    found = {r.doc_id: r.labels for r in licenses.license_scan(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert found == {1: "bsd", 2: "bsd", 3: "", 4: "", 5: "cc-by-nc-4.0"}


@pytest.mark.parametrize("times", [2, 3, 1000])
def test_notices_in_a_row_are_all_found(spark, times):
    """Verbatim copies one after the other, and changed ones, whose diagonals all lie close together."""
    texts = [*licenses.NOTICES, *licenses.PHRASES]
    given = [(n, ". ".join([text] * times)) for n, text in enumerate(texts)]
    changed = ["all rights rights reserved", next(n for n, label in licenses.NOTICES.items() if label == "bsd").replace("binary", "binary really")]
    given += [(100 + n, " ".join([text] * times)) for n, text in enumerate(changed)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    found = {r.doc_id: (r.labels.split(","), r.n_base, r.score) for r in licenses.license_scan(df).collect()}
    labels = {**licenses.NOTICES, **licenses.PHRASES}
    for n, text in enumerate(texts):
        assert labels[text] in found[n][0] and found[n][2] == 1.0
    assert all(found[n][1] == times for n, text in enumerate(texts) if text in licenses.PHRASES)
    assert found[100][0] == ["all-rights-reserved"] and found[101][0] == ["bsd"]
    # Every verbatim copy is a span of its own, at the words it stands at.
    spans = Counter((r.doc_id, r.start, r.end) for r in licenses.found_spans(df).where("cover = 1").collect())
    for n, text in enumerate(texts):
        size = len(brute.words(text))
        assert all(spans[n, k * size, (k + 1) * size] for k in range(times))


def test_each_reading_of_the_texts_cuts_them_once(spark):
    """Places and sizes take the words of a text from one cut, and breaks at its ends make no word."""
    ends = ["", " ", "\x00", "\x7f", ".-/", ":@[`{~\x7f\x1f"]
    given = [(n, f"{a}MIT{b or ' '}license{c}") for n, (a, b, c) in enumerate(product(ends, repeat=3))]
    given += [(1_000 + n, text) for n, text in enumerate([*ends, None, "mit", "é\U0001f600\u2028ß mit License", "\u00a0MIT license\u0080"])]
    df = spark.createDataFrame(given, "doc_id long, text string")
    expected = Counter((d, *brute.licenses(t)) for d, t in given)
    assert tuples(licenses.license_scan(df), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == expected
    for readings, frame in ((1, licenses.diagonals(df)), (2, licenses.license_scan(df))):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("lower(") == readings


# --- 10: language ---------------------------------------------------------------------------


def test_held_out_accuracy(documents):
    found = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 20 and sum(r.lang_pred == r.lang for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_awkward_rows(docs, rows):
    import zlib

    found = language.identify(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, _ in rows)
    texts = dict(rows)
    for r in found:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3, 15, 25})


def test_language_without_labels(docs):
    found = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_every_label_is_trained_and_the_rows_are_bounded(spark):
    """Languages of one letter each: 66 frequent ones and four of a few rows."""
    rng = np.random.default_rng(8)
    letters = [chr(0x4E00 + 67 * n) for n in range(70)]
    given = [(0, n) for n in range(66) for _ in range(12)] + [(0, n) for n in range(66, 70) for _ in range(5)]
    ids = iter(k for k in range(10**6) if zlib.crc32(str(k).encode()) % 5)
    given = [(next(ids), letters[n] * int(rng.integers(20, 60)), f"l{n:02}") for _, n in given]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string")
    names = {lang for *_, lang in given}
    assert len(names) == 70 and {r[0] for r in language.training_sample(df)} == names
    for rows in (1, 140):
        sample = language.training_sample(df, rows=rows)
        assert {r[0] for r in sample} == names and len(sample) <= max(70, rows) + 70
    assert language.trained(df).languages == sorted(names)
    right = {d: lang for d, _, lang in given if lang >= "l66"}
    found = {r.doc_id: r.lang_pred for r in language.identify(df).collect()}
    assert sum(found[d] == lang for d, lang in right.items()) >= 0.8 * len(right)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = language.ByteNet(["a", "b", "c"])
    x, label = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    loss = lambda: float(-np.log(net.ready().probabilities(x)[np.arange(5), label]).mean())
    for p, g in zip(net.parameters(), net._gradients(x, label)):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        old, step = p[at], 1e-2
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert (up - down) / (2 * step) == pytest.approx(float(g[at]), rel=0.05, abs=1e-3)


# --- all ------------------------------------------------------------------------------------


def test_empty_tables(no_docs, spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    for result in (
        suffix_dedup.repeated_passages(no_docs), suffix_dedup.remove_repeats(no_docs), pii.find_personal_data(no_docs), pii.mask(no_docs),
        line_dedup.remove_boilerplate(no_docs), line_dedup.keep_cleaned(no_docs), decontaminate.contamination(no_docs, nothing),
        decontaminate.longest_matches(no_docs, nothing), packing.pack(no_docs, BYTES), simhash.near_duplicates(no_docs),
        simhash.keep_one(no_docs), token_counts.token_counts(no_docs, PIECES), licenses.license_scan(no_docs),
        language.identify(no_docs), language.keep_identified(no_docs),
    ):
        assert result.collect() == []


def test_no_items(docs, rows, spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert tuples(decontaminate.contamination(docs, nothing)) == Counter(brute.contamination(rows, []))
