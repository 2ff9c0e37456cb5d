"""Quality rules, line dedup and token counts against plain Python."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabflow.llm.common import scratch_path
from tabflow.llm.cuckoo import CuckooFilter, FilterFull, build
from tabflow.llm.line_dedup import build_index, dedup_lines
from tabflow.llm.packing import GROUP_PIECES, SumOfSquares, cut, pack, pack_documents, pieces, sequences
from tabflow.llm.quality_rules import RULES, Rule, keep_good, quality_rules
from tabflow.llm.token_counts import at_limits, length_histogram, quantile, token_lengths
from tabflow.llm.token_files import read_tokens, write_tokens
from tabflow.llm.tokens import Encoder
from tests.llm.fixtures import TOKENIZER, awkward, empty, rows

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_quality_measures_match_plain_python(spark):
    rng = random.Random(1)
    texts = [
        (i, "".join(rng.choice(["a b ", "c ", "the\n", "#|", "é ", "a b c d e f ", "\n", "\t"]) for _ in range(rng.randint(0, 60))))
        for i in range(150)
    ]
    for docs in (awkward(spark), awkward(spark, texts)):
        got = quality_rules(docs).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
        )
        want = sorted(((r["doc_id"], *_measures(r["text"])) for r in docs.collect()), key=repr)
        assert rows(got) == want


def test_quality_filter_keeps_rows_and_columns(spark):
    docs = awkward(spark)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    verdict = quality_rules(docs).where("kept")
    assert rows(kept.select("doc_id")) == rows(verdict.select("doc_id"))
    assert keep_good(empty(spark)).count() == 0
    # without rules only the base decides; a rule's name is reported
    assert {tuple(r["failed"]) for r in quality_rules(docs, []).collect()} == {()}
    assert all("mean_word_chars" in r["failed"] for r in quality_rules(docs, [Rule("mean_word_chars", low=1e9)]).collect())
    assert {r.metric for r in RULES} <= set(quality_rules(docs).columns)


def test_stop_words_count_in_known_languages_only(spark):
    english = " ".join(["the house of my friend is in a small town"] * 4 + ["end"])
    strange = " ".join(f"slowo{i}" for i in range(60))
    rule = [Rule("stop_word_ratio", low=0.02)]
    texts = [english, english.upper(), english.title(), strange]
    langs = ["en", "EN", "de-AT", "it", "pl", None]
    docs = spark.createDataFrame(
        [(i, text, lang) for i, (text, lang) in enumerate((t, g) for t in texts for g in langs)], "doc_id long, text string, lang string"
    )
    failed = {(r["text"], r["lang"]) for r in quality_rules(docs, rule).join(docs.select("doc_id", "lang"), "doc_id").collect() if r["failed"]}
    assert failed == {(strange, lang) for lang in ("en", "EN", "de-AT")}
    assert all(not r["failed"] for r in quality_rules(docs.drop("lang"), rule).collect())


def _line_dedup(docs, min_chars=20, min_docs=3):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        gone = lambda x: doc_id is not None and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != doc_id  # noqa: E731, B023
        kept = [x for x in lines if not gone(x)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def _got(docs, index):
    return rows(dedup_lines(docs, index).select("doc_id", "_n_lines", "_n_dropped", "text"))


def test_line_dedup_matches_plain_python(spark):
    rng = random.Random(5)
    pool = ["A Line that is long enough %d" % i for i in range(12)] + ["short", "", "  ünïcode line, twenty chars  "]
    texts = [(i % 37, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    for docs in (awkward(spark), awkward(spark, texts)):
        plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = _got(docs, build_index(docs))
        assert got == _line_dedup(plain)
    assert set(docs.columns) <= set(dedup_lines(docs, build_index(docs)).columns)


def test_line_index_is_reversible(spark):
    line = "the very same line in all of them"
    texts = [(i, f"{line}\nonly number {i} has this long line\n" + ("shared by a few of the documents" if i < 4 else "")) for i in range(8)]
    first, more = awkward(spark, texts[:5]), awkward(spark, texts[5:])
    both = awkward(spark, texts)
    small = build_index(first)
    grown = small.insert(more)
    assert rows(grown.counts) == rows(build_index(both).counts)
    assert _got(both, grown) == _line_dedup(texts)
    assert rows(grown.insert(more).counts) == rows(grown.counts)  # held keys are not counted twice
    back = grown.delete(more)
    assert rows(back.counts) == rows(small.counts)
    assert _got(first, back) == _line_dedup(texts[:5])
    fewer = grown.delete(spark.createDataFrame([(i,) for i in range(1, 8)], "doc_id long"))
    assert _got(awkward(spark, texts[:1]), fewer) == _line_dedup(texts[:1])
    # a filter that is full is built anew
    lines = "\n".join(f"line number {k:05d} of many lines" for k in range(40))
    wide = small.insert(awkward(spark, [(100 + i, lines) for i in range(3)]))
    assert wide.common.count() == 40 + small.common.count()
    assert sum(r["_n_dropped"] for r in dedup_lines(awkward(spark, [(100, lines)]), wide).collect()) == 40


def test_small_inserts_never_fill_a_filter(spark):
    """A few common lines, then a few more: some fills find no free slot below
    the filter's load, and the shard is built anew."""
    import tabflow.llm.line_dedup as module

    line = lambda k: f"common line number {k:06d} of all"
    texts = lambda ks: [(1000 * min(ks) + d, "\n".join(map(line, ks))) for d in range(3)]
    found = None
    for start in range(0, 40_000, 10):  # four and two keys whose fill fails, by the filter's own rule
        keys = [np.array(x) for x in zip(*[module._hash(line(k).encode()) for k in range(start, start + 6)], strict=True)]
        made = build(keys[0][:4], keys[1][:4])
        try:
            made.insert(keys[0][4:], keys[1][4:])
        except FilterFull:
            found = start
            break
    assert found is not None and made.room() >= 6
    index = build_index(awkward(spark, texts(range(found, found + 4)))).insert(awkward(spark, texts(range(found + 4, found + 6))))
    assert index.common.count() == 6 and index.filters.where("filter is null").isEmpty()
    every = "\n".join(line(k) for k in range(found, found + 6))
    assert [r["_n_dropped"] for r in dedup_lines(awkward(spark, [(5, every)]), index).collect()] == [6]


def test_a_hot_line_is_probed_by_many_tasks(spark):
    docs = awkward(spark, [(i, "the hot line that all the documents hold\n" + f"own line {i % 50} of a few documents") for i in range(600)])
    index = build_index(docs)
    plain = rows(index.drops(docs))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # fewer partitions than shards would salt nothing
    try:
        spread = index.drops(docs, hot_docs=50)
        assert rows(spread) == plain and len(plain) == 599 + 550
        text = spread._jdf.queryExecution().optimizedPlan().toString()
        assert "more" in text
        hot = index.common.where("n_docs > 50").count()
        assert hot == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_line_dedup_of_empty_tables(spark):
    index = build_index(empty(spark))
    assert dedup_lines(empty(spark), index).count() == 0
    assert _got(awkward(spark, [(1, None)]), index) == [(1, 1, 0, "")]


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = rng.integers(-(2**63), 2**63 - 1, (2, 20_000))
    made = build(*keys[:, :10_000])
    assert made.contains(*keys[:, :10_000]).all()
    assert made.contains(*keys[:, 10_000:]).mean() < 0.001
    made = CuckooFilter.from_bytes(made.to_bytes())
    made.delete(*keys[:, :4_000])
    assert made.contains(*keys[:, 4_000:10_000]).all() and made.contains(*keys[:, :4_000]).mean() < 0.01
    assert made.stored == 6_000
    with pytest.raises(KeyError):
        CuckooFilter.for_keys(8).delete(*keys[:, :1])
    with pytest.raises(FilterFull):
        CuckooFilter.for_keys(8).insert(*keys[:, :1000])


def test_encoder_equals_the_tokenizer():
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    rng = random.Random(2)
    alphabet = [*" \n\ta'sé1.,  _²½-\0日\x1c\x85", "ab", " the", ". ", ", a", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    calm = [*"a'sé1²½", " the", ". B", ", a", "\nA", " b"]
    texts += ["".join(rng.choice(calm) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    own = Encoder(TOKENIZER)
    for _ in range(2):  # new cuts, then known ones
        for text, ids in zip([None, *texts], own.encode([None, *texts]), strict=True):
            want = plain.encode(text, add_special_tokens=False).ids if text else []
            assert np.frombuffer(ids, "<u4").tolist() == want, text


def _thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


def test_texts_that_share_a_hash_keep_their_own_ids(spark):
    """A Thue-Morse text and its complement share every polynomial hash modulo 2**64."""
    plain = Tokenizer.from_file(TOKENIZER)
    swap = str.maketrans("ab", "ba")
    texts = [t for k in (1024, 2048, 4096, 8192) for t in (_thue_morse(k), _thue_morse(k).translate(swap))]
    texts += [f"one {a} two {b}." for a, b in zip(texts, texts[1:], strict=False)] + texts[::-1]
    own = Encoder(TOKENIZER)
    assert len(set(own._hash(*(np.array(x) for x in ([*(texts[0] + texts[1]).encode()], [0, 1024], [1024, 2048]))).tolist())) == 1
    for _ in range(2):
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    docs = awkward(spark, list(enumerate(texts))).coalesce(1)
    want = [(i, len(plain.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    assert rows(token_lengths(docs, TOKENIZER)) == sorted(want, key=repr)
    crc = lambda t, end: zlib.crc32(np.array([*plain.encode(t, add_special_tokens=False).ids, end], "<u4").tobytes())
    path = scratch_path(spark, "test-same-hash")
    write_tokens(docs, path, TOKENIZER, 0)
    got = read_tokens(spark, path).select("doc_id", "ids_crc32")
    assert rows(got) == sorted(((i, crc(t, 0)) for i, t in enumerate(texts)), key=repr)
    packed = pack_documents(docs, TOKENIZER, 2, 1 << 16).select("doc_id", "ids_crc32")
    assert rows(packed) == sorted(((i, crc(t, 2)) for i, t in enumerate(texts)), key=repr)


def test_special_tokens_are_those_of_the_plain_call(spark):
    plain = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(6)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>. y", "a <|endoftext|", "É <|endoftext|><|endoftext|>日"]
    texts += ["".join(rng.choice(["a", " b", ". C", " ", "<|endoftext|>"]) for _ in range(rng.randint(0, 25))) for _ in range(500)]
    for text, ids in zip(texts, Encoder(TOKENIZER, special_tokens=True).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    # the operators take the same ids
    docs = awkward(spark, list(enumerate(texts[:5])))
    want = [(i, len(plain.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(texts[:5])]
    assert rows(token_lengths(docs, TOKENIZER)) == want
    packed = pack_documents(docs, TOKENIZER, 2, 64).collect()
    assert sorted((r["doc_id"], r["length"] - 1) for r in packed) == want
    path = scratch_path(spark, "test-special-tokens")
    write_tokens(docs, path, TOKENIZER, 0)
    crc = lambda t: zlib.crc32(np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes())
    got = read_tokens(spark, path).select("doc_id", "ids_crc32")
    assert rows(got) == [(i, crc(t)) for i, t in enumerate(texts[:5])]


def _lengths(docs):
    plain = Tokenizer.from_file(TOKENIZER)
    return [(r["doc_id"], plain.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()]


def test_token_histogram(spark):
    docs = awkward(spark)
    lengths = [len(ids) for _, ids in _lengths(docs)]
    histogram = length_histogram(token_lengths(docs, TOKENIZER))
    want = []
    for n in set(lengths):
        longer = [x for x in lengths if x >= n]
        share = sum(x <= n for x in lengths) / len(lengths)
        want.append((n, lengths.count(n), len(longer), sum(longer), share, sum(min(x, n) for x in lengths)))
    assert rows(histogram) == sorted(want, key=repr)
    for limit, whole, cut_docs, kept in at_limits(histogram, [0, 5, 10**6]).collect():
        assert whole == sum(x <= limit for x in lengths) and cut_docs == len(lengths) - whole
        assert kept == sum(min(x, limit) for x in lengths)
    assert quantile(histogram, 0.5).first()[0] == sorted(lengths)[-(-len(lengths) // 2) - 1]
    assert length_histogram(token_lengths(empty(spark), TOKENIZER)).count() == 0


def test_cut_makes_full_pieces_after_the_first():
    for n in range(1, 40):
        parts = list(cut(n, 8))
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert sum(p[2] for p in parts) == n and all(p[2] == 8 for p in parts[1:]) and parts[0][2] <= 8
        assert [p[1] for p in parts] == [sum(q[2] for q in parts[:i]) for i in range(len(parts))]


def test_packing_is_whole_and_gapless(spark):
    docs = awkward(spark)
    capacity = 64
    packed = pack_documents(docs, TOKENIZER, 2, capacity).collect()
    want = Counter()
    for doc_id, ids in _lengths(docs):
        for piece, start, length in cut(len(ids) + 1, capacity):
            want[(doc_id, piece, start, length)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in packed) == want
    by_sequence = defaultdict(list)
    for r in packed:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_sequence) <= -(-sum(r["length"] for r in packed) // capacity) + 3
    assert pack_documents(empty(spark), TOKENIZER, 2).count() == 0


def test_full_pieces_and_equal_rows_without_id_are_spread(spark):
    full = spark.range(20000).selectExpr("1L doc_id", "int(id) piece", "id * 8 start", "8L length", "5L ids_crc32")
    same = spark.range(20000).selectExpr("CAST(NULL AS LONG) doc_id", "0 piece", "0L start", "3L length", "7L ids_crc32")
    for parts, groups in ((full, 1), (same, 8)):
        packed = pack(parts, 8, groups * GROUP_PIECES).withColumn("task", F.spark_partition_id())
        counts = [r["count"] for r in packed.groupBy("task").count().collect()]
        assert sum(counts) == 20000 and max(counts) < 10000
    alone = pack(full, 8, 1)
    assert alone.select("sequence_id").distinct().count() == 20000 and alone.where("offset > 0").isEmpty()


def test_packed_sequences_hold_the_ids(spark):
    docs = awkward(spark, [(i, "word " * (7 * i)) for i in range(1, 9)])
    parts = pieces(docs, TOKENIZER, 2, 32, with_ids=True)
    made = sequences(pack(parts, 32, 8), parts)
    got = b"".join(sorted(r["ids"] for r in made.collect()))
    assert Counter(np.frombuffer(got, "<u4").tolist()) == Counter(x for _, ids in _lengths(docs) for x in [*ids, 2])


def test_sum_of_squares_places_greedily():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 50) for _ in range(400)), reverse=True)
    packer, gaps = SumOfSquares(50), []
    for size in sizes:
        sequence, offset = packer.place(size)
        counts = Counter(g for g in gaps if 0 < g)
        cost = lambda g: sum(v * v for k, v in (counts - Counter([g]) + Counter([g - size])).items() if k)  # noqa: B023, E731
        fitting = {g for g in counts if g >= size}
        if sequence == len(gaps):
            assert not fitting and offset == 0
            gaps.append(50 - size)
        else:
            assert cost(gaps[sequence]) == min(map(cost, fitting)) and offset == 50 - gaps[sequence]
            gaps[sequence] -= size
    assert len(gaps) <= -(-sum(sizes) // 50) + 2


def test_kept_text_hash_is_of_the_utf8_bytes(spark):
    got = spark.createDataFrame([("é",)], "t string").select(F.sha2("t", 256)).first()[0]
    assert got == hashlib.sha256("é".encode()).hexdigest()
