"""Mixing, spelling variants and manifests against plain Python."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabflow.llm.common import materialize
from tabflow.llm.manifest import fold, leaf_digest, manifest, proof_digest
from tabflow.llm.mixing import measure, targets, uniform
from tabflow.llm.mixing import mix as mix_measured
from tabflow.llm.order import ordered
from tabflow.llm.spelling import corrupted_words, neighbours, variants, vocabulary
from tests.llm.fixtures import awkward, empty, rows

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _first(value):
    """Sort key with nulls first."""
    return value is not None, value if value is not None else 0


# --- order -------------------------------------------------------------------


@pytest.mark.parametrize("hot", [False, True])
def test_places_equal_a_plain_sort(spark, hot):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", "é", None, "hot"]) if not hot else "hot", rng.choice([1, 2, None]), rng.randint(0, 9)) for _ in range(900)]
    table = materialize(spark.createDataFrame(data, "grp string, k long, size long").repartition(7), "test-order")
    found = ordered(table, ["grp"], ["k"], "size")
    got = found.rows().collect()
    groups = sorted({g for g, _, _ in data}, key=lambda g: (g is not None, (g or "").encode()))
    assert {(r["_group"], r["grp"], r["_group_rows"], r["_group_size"]) for r in found.groups().collect()} == {
        (i, g, sum(x[0] == g for x in data), sum(x[2] for x in data if x[0] == g)) for i, g in enumerate(groups)
    }
    assert sorted((r["grp"] or "", r["k"] or 0, r["size"]) for r in got) == sorted((g or "", k or 0, s) for g, k, s in data)
    for number, group in enumerate(groups):
        own = sorted((r for r in got if r["grp"] == group), key=lambda r: r["_position"])
        assert [r["_position"] for r in own] == list(range(len(own))) and {r["_group"] for r in own} == {number}
        assert [_first(r["k"]) for r in own] == sorted(_first(r["k"]) for r in own)
        assert [r["_before"] for r in own] == [sum(x["size"] for x in own[:i]) for i in range(len(own))]
    assert ordered(materialize(table.limit(0), "test-order"), ["grp"], ["k"]).rows().count() == 0


# --- mixing ------------------------------------------------------------------


def _plain_targets(sizes, weights, epochs):
    """The contract's rule: stop at the limit, share the excess, until none is above."""
    total, full, left = sum(sizes), {}, dict(enumerate(sizes))
    while left:
        rest, among = total - sum(full.values()), sum(weights[i % len(weights)] for i in left)
        above = [i for i in left if weights[i % len(weights)] * rest / among > epochs * left[i] + 1e-9]
        if not above:
            return [float(full[i]) if i in full else weights[i % len(weights)] * rest / among for i in range(len(sizes))]
        for i in above:
            full[i] = epochs * left.pop(i)
    return [float(full[i]) for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_plain_rounds(spark, seed):
    rng = random.Random(seed)
    sizes = [int(10 ** rng.uniform(0, 6)) * rng.choice([0, 1, 1]) for _ in range(rng.randint(1, 30))]
    table = spark.createDataFrame(list(enumerate(sizes)), "_group long, _group_size long")
    got = [r["target"] for r in sorted(targets(table, (5, 2, 1), 3).collect())]
    assert got == pytest.approx(_plain_targets(sizes, (5, 2, 1), 3))
    assert sum(got) == pytest.approx(sum(sizes))


def mix(docs, weights, epochs=3, seed=0):
    return mix_measured(measure(docs, seed, ["weight"]), weights, epochs)


def _corpus(spark, n=400, seed=5):
    rng = random.Random(seed)
    source = lambda i: "hot" if i % 3 == 0 else rng.choice(["b", "c", "é", None])
    data = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 60))), source(i), rng.choice([0.5, 1.0, 2.0])) for i in range(n)]
    data += [(None, None, "b", 1.0), (7, "", "c", None), (8, " \t\n", "empty", 1.0), (9, "one two", "tiny", 0.0)]
    data += [(None, "same words here", "b", 1.0)] * 30
    return spark.createDataFrame(data, "doc_id long, text string, source string, weight double")


def test_mix_equals_plain_sampling(spark):
    docs = _corpus(spark).withColumn("size", F.lit("clash")).withColumn("target", F.lit("clash"))
    got = mix(docs, (5, 2, 1), 3, 4)
    u = {(r["doc_id"], r["text"]): r["u"] for r in docs.select("doc_id", "text", uniform(4, F.col("doc_id"), F.col("text")).alias("u")).collect()}
    by_source = defaultdict(list)
    for r in docs.collect():
        weight = max(r["weight"] or 0, 1e-6)
        key = -math.log(u[r["doc_id"], r["text"]]) / weight
        by_source[r["source"]].append((key, _first(r["doc_id"]), len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))))
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(x[2] for x in by_source[s]) for s in names]
    want = []
    for name, size, target in zip(names, sizes, _plain_targets(sizes, (5, 2, 1), 3), strict=True):
        epochs, before = (int(min(target // size, 3)) if size else 0), 0
        for _, (_, doc_id), own in sorted(by_source[name]):
            more = epochs < 3 and own > 0 and 2 * before + own <= 2 * (target - epochs * size)
            before += own
            want.append((name, own, size, own * (epochs + more)))
    assert rows(got.select("source", "size", "source_size", "taken")) == sorted(want, key=repr)
    assert rows(got) == rows(mix(docs.repartition(5), (5, 2, 1), 3, 4))  # reruns agree
    totals = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("size").alias("most"), F.max("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) <= r["most"] / 2 for r in totals.collect())
    assert got.where("taken > 3 * size").count() == 0


def test_heavier_documents_are_drawn_more_often(spark):
    docs = spark.createDataFrame([(i, "word " * 10, "ab"[i % 2], [0.2, 5.0][i // 2 % 2]) for i in range(4000)], "doc_id long, text string, source string, weight double")
    drawn = mix(docs, (3, 1)).join(docs.select("doc_id", "weight"), "doc_id").where("source = 'b'")
    share = {r["weight"]: r["share"] for r in drawn.groupBy("weight").agg(F.avg(F.col("sampled").cast("int")).alias("share")).collect()}
    # of two kinds of equal number, with half of all taken, the heavy one: 1 - t**25 with t + t**25 = 1 and so on
    assert share[5.0] > 0.85 and share[0.2] < 0.15


def test_mix_of_awkward_tables(spark):
    docs = awkward(spark).withColumns({"source": F.lit(None).cast("string"), "weight": F.lit(1.0)})
    got = mix(docs, (5, 2, 1)).collect()
    assert len(got) == docs.count() and {r["taken"] for r in got} == {r["size"] for r in got}
    assert {r["epochs"] for r in got} == {1} and not any(r["sampled"] for r in got)
    assert mix(docs.limit(0), (5, 2, 1)).count() == 0
    nothing = mix(docs.withColumn("text", F.lit(None).cast("string")), (5, 2, 1)).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in nothing} == {(0, 0.0, 0)}
    with pytest.raises(ValueError):
        mix(docs, (5, 0))


# --- spelling ----------------------------------------------------------------


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("trie_chars", [4, 9])
def test_neighbours_equal_all_pairs(spark, trie_chars):
    """Words below, at and above the border of the trie, runs of one letter included."""
    rng = random.Random(trie_chars)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(250)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(150)}
    words |= {"a" * k for k in range(1, 20)} | {"ab" * k for k in range(1, 9)}
    base = "".join(rng.choice("abc") for _ in range(17))
    for i in range(17):
        words |= {base[:i] + base[i + 1 :], base[:i] + "z" + base[i + 1 :], base[:i] + "ÿ" + base[i:]}
    words = sorted(words)
    table = materialize(spark.createDataFrame([(w,) for w in words], "word string"), "test-words")
    got = [tuple(r) for r in neighbours(table, trie_chars).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if _one_edit(a, b)}


def test_a_very_long_word_has_its_neighbours(spark):
    word = "".join(random.Random(1).choices("abcdefghij", k=60_000))
    words = [word, word[:100] + word[101:], word[:-1] + "z", word[::-1], "c" * 60_000, "c" * 59_999, "c" * 59_998]
    table = materialize(spark.createDataFrame([(w,) for w in words], "word string"), "test-words")
    got = sorted((words.index(a), words.index(b)) for a, b in neighbours(table).collect())
    assert got == [(0, 1), (0, 2), (1, 0), (2, 0), (4, 5), (5, 4), (5, 6), (6, 5)]


def _plain_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id if doc_id is not None else ''}:{run}".encode())
            at = h % len(run)
            word = run[:at] + run[at + 1 :] if h % 31 == 0 else run
            counts[word] += len(word) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and _one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return sorted(out, key=repr)


def test_variants_equal_plain_python(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(6, 12))) for _ in range(40)]
    typo = lambda w: w[: (i := rng.randrange(len(w)))] + rng.choice(["", "x", "é"]) + w[i + 1 :]
    texts = []
    for i in range(250):
        words = [w if rng.random() < 0.9 else typo(w) for w in rng.choices(base[:4] * 30 + base, k=rng.randint(0, 60))]
        texts.append((i if i % 50 else None, rng.choice([" ", ", ", "1", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    # chains of forms: 1000 to 100 to 10 to 2
    texts += [(1000, "chainword " * 2000 + "chainworda " * 200 + "chainwordab " * 20 + "chainwordabc " * 2), (1001, None), (1002, ""), (1003, " ")]
    docs = awkward(spark, texts)
    got = variants(vocabulary(corrupted_words(docs))).select("word", "n", "n_near", "form", "form_n", "root")
    want = _plain_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows(got) == want
    assert any(w[3] is not None and w[5] != w[3] for w in want)  # a chain was there
    assert variants(vocabulary(corrupted_words(empty(spark)))).count() == 0
    assert variants(vocabulary(corrupted_words(awkward(spark)))).count() == len(_plain_variants([(r["doc_id"], r["text"]) for r in awkward(spark).collect()]))


# --- manifest ----------------------------------------------------------------


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(nodes, arity):
    """The root, and for each node its (before, after) on every level."""
    ways, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for w, at in zip(ways, place, strict=True):
            low = at // arity * arity
            w.append(("".join(nodes[low:at]), "".join(nodes[at + 1 : low + arity])))
        place = [at // arity for at in place]
        nodes = [_h("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], ways


@pytest.mark.parametrize("arity", [2, 8])
def test_manifest_equals_a_plain_tree(spark, arity):
    data = [(i, ["en", "de", None, "é", f"lang{i}"][min(i % 11, 4)] if i % 11 < 5 else "en", f"text {i}") for i in range(260)]
    data += [(None, "en", "x"), (None, "en", "x"), (3, "en", None), (3, "en", ""), (5, "lone", "y"), (5, "", "z")]
    docs = spark.createDataFrame(data, "doc_id long, lang string, text string").withColumns({"g": F.lit("clash"), "i": F.lit("clash"), "n": F.lit(0)})
    table = docs.withColumn("leaf", leaf_digest([F.col("doc_id"), F.col("lang"), F.col("text")]))
    got = manifest(table, "lang", ["doc_id"], arity=arity)
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for row in data:
        groups[row[1]].append((_first(row[0]), _h("".join(map(part, row)))))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: _tree([leaf for _, leaf in sorted(groups[x])], arity) for x in names}
    root, up = _tree([trees[x][0] for x in names], arity)
    want = []
    for name, above in zip(names, up, strict=True):
        for (_, leaf), way in zip(sorted(groups[name]), trees[name][1], strict=True):
            want.append((leaf, trees[name][0], root, _h("".join(a + b for a, b in way + above))))
    shown = got.select("leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof"))
    assert rows(shown) == sorted(want, key=repr)
    # every row folds to the root, a changed one does not
    folded = got.select(fold(F.col("leaf"), F.col("path")).alias("own"), fold(F.sha2(F.lit("other"), 256), F.col("path")).alias("other"))
    assert all(r["own"] == root != r["other"] for r in folded.collect())


def test_manifest_of_small_tables(spark):
    docs = awkward(spark).withColumn("leaf", leaf_digest([F.col("doc_id"), F.col("text")]))
    assert manifest(docs.limit(0), "label", ["doc_id"]).count() == 0
    lone = manifest(docs.where("doc_id = 4"), "label", ["doc_id"]).first()
    assert lone["leaf"] == lone["subroot"] == lone["root"] and lone["path"] == []
    got = manifest(docs, "label", ["doc_id"])
    assert got.columns == [*docs.columns, "subroot", "root", "path"] and got.count() == docs.count()
    assert got.where(fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert rows(got) == rows(manifest(docs.repartition(3), "label", ["doc_id"]))
