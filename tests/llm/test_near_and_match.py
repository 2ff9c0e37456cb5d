"""Near-dedup, components and decontamination against brute force."""

import random
import re

import pyarrow as pa

from tabflow.llm import minhash
from tabflow.llm.components import components
from tabflow.llm.decontamination import Matcher, benchmark_matches, drop_contaminated, normalized
from tabflow.llm.minhash import Similarity, keep_one, near_duplicates, shingles
from tabflow.llm.line_dedup import build_index, dedup_lines
from tests.llm.fixtures import awkward, empty, rows


def _least(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def _brute(texts, similarity):
    """(n_shingles, component) of each doc_id; texts with unique ids."""
    sets = {}
    for doc_id, text in texts:
        words = (text or "").encode().lower().split()
        k = similarity.shingle_words
        sets[doc_id] = {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
    ids = sorted(sets)
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity.percent * len(sets[a] | sets[b])
    ]
    least = _least(ids, links)
    return sorted((i, len(sets[i]), least[i], least[i] == i) for i in ids)


def _family(rng, base, first, edits, n):
    """Copies of ``base`` with some words changed."""
    out = []
    for i in range(n):
        words = base.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append((first + i, " ".join(words)))
    return out


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(7)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    hub, common = text(100), text(60)
    texts = [(500, hub), *_family(rng, hub, 0, 3, 60)]  # copies near their origin, mostly not each other
    for k, edits in enumerate((1, 2, 4, 8, 12)):
        texts += _family(rng, text(120), 1000 + 100 * k, edits, 25)
    texts += [(3000 + i, f"{common} {text(12)}") for i in range(60)]  # a passage in many documents
    texts += [(4000 + i, text(rng.randint(1, 4))) for i in range(20)]
    chain = text(80).split()
    for i in range(20):
        chain[4 * i % 80] = f"c{i}"
        texts.append((5000 + i, " ".join(chain)))
    docs = awkward(spark, texts)
    for similarity in (Similarity(3, 85), Similarity()):
        assert rows(near_duplicates(docs, similarity)) == sorted(_brute(texts, similarity), key=repr)


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    got = {}
    for doc_id, n, component, kept in near_duplicates(docs).collect():
        got.setdefault(doc_id, set()).add((n > 0, component, kept))
    assert got[None] == {(True, None, True)}
    assert got[2] == got[3] == {(True, 1, False)} and got[1] == {(True, 1, True)}
    assert got[4] == {(False, 4, True)} and got[5] == {(False, 5, True)} and got[6] == {(False, 6, True)}
    assert got[11] == {(True, 11, True)} and got[12] == {(True, 11, False)}
    assert got[9] == {(True, 9, True), (False, 9, True)}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 4, 5, 6, 7, 9, 9, 11], key=repr)
    assert near_duplicates(empty(spark)).count() == 0 and keep_one(empty(spark)).count() == 0


def test_keep_one_judges_rows_that_share_an_id_by_their_texts(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(9000)}" for _ in range(40))
    a, b, c, d = (text() for _ in range(4))
    texts = [(7, a), (7, b), (3, b), (7, a), (None, c), (None, c), (None, d), (8, d), (None, None), (9, ""), (9, "")]
    kept = keep_one(awkward(spark, texts)).select("doc_id", "text")
    assert rows(kept) == sorted([(7, a), (3, b), (None, c), (8, d), (None, None), (9, ""), (9, "")], key=repr)


def test_shingles_lower_only_ascii_and_split_at_ascii_space():
    assert len(shingles("A b\x0bc d", 2)) == 2
    assert set(shingles("ONE two", 5)) == set(shingles("one\tTWO", 5)) and len(shingles("x", 3)) == 1
    assert not set(shingles("É a", 2)) & set(shingles("é a", 2))
    assert len(shingles("a b a b a b", 3)) == 2


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    for node, least in _least({x for e in links for x in e}, links).items():
        assert got.get(node, node) == least
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def _distance(item, text, anywhere):
    before = [0 if anywhere else j for j in range(len(text) + 1)]
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before) if anywhere else before[-1]


def test_matcher_matches_brute_force():
    rng = random.Random(1)
    noise = lambda n: "".join(rng.choice("abc \n") for _ in range(n))
    for _ in range(250):
        item = noise(rng.randint(1, 25)).strip() or "a"
        edited = list(item)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(edited) + 1)
            edited[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        text = noise(20) + "".join(edited) + noise(20)
        plain, budget = normalized(item).strip(), int(len(normalized(item).strip()) * 0.2)
        found = list(Matcher([(1, item)], 0.2).find(text))
        best = _distance(plain, normalized(text), True)
        parted = re.search(rf"(?<!\w){re.escape(plain)}(?!\w)", normalized(text)) is not None
        assert bool(found) == (best <= budget if budget else parted)
        for _, start, end, distance in found:
            assert _distance(plain, normalized(text[start:end]), False) == distance <= budget
        if found:
            assert min(f[3] for f in found) == best


def test_white_space_does_not_count():
    item = "the quick brown fox jumps over the lazy dog"
    text = "a  b\n\n" + item.replace(" ", " \n\t ") + "  !  "
    ((_, start, end, distance),) = Matcher([(1, item)], 0.1).find(text)
    assert distance == 0 and text[start:end].split() == item.split()


def test_two_passages_in_a_text_are_two_matches():
    item = "the quick brown fox jumps over the lazy dog again"
    text = f"x {item.upper()} yy {item.replace('fox', 'fux')}"
    assert [(m[0], m[3]) for m in Matcher([(9, item)], 0.1).find(text)] == [(9, 0), (9, 1)]


def test_short_items_are_whole_words():
    found = lambda item, text: [m[1:3] for m in Matcher([(1, item)], 0.1).find(text)]
    assert found("the", "theatre, bathe, other") == [] and found("is", "theatre is") == [(8, 10)]
    assert found("the", "theatre the THE") == [(8, 11), (12, 15)] and found("c++", "(c++)") == [(1, 4)]
    assert found("日本", "私は日本人") == [(2, 4)]


def test_only_rows_that_hold_an_item_go(spark):
    item = "a benchmark passage of some words that nobody else would write down"
    bench = spark.createDataFrame([(1, item), (2, "is")], "item_id long, text string")
    texts = [(1, item), (1, "clean"), (1, None), (None, f"x {item}"), (None, "theatres"), (2, "it is"), (2, "it was"), (2, "it is")]
    left = drop_contaminated(awkward(spark, texts), bench)
    assert rows(left.select("doc_id", "text")) == sorted([(1, "clean"), (1, None), (None, "theatres"), (2, "it was")], key=repr)


def test_benchmark_matches_and_filter(spark):
    item = "a benchmark passage of some words that nobody else would write down"
    bench = spark.createDataFrame(
        [(1, item), (2, item), (3, None), (4, "  "), (None, "never found zzzzzzzz"), (5, "")], "item_id long, text string"
    )
    long = "filler words " * 5000
    texts = [(1, f"{long}{item}{long}"), (2, None), (3, ""), (None, item), (4, item.replace("some", "sxme").replace(" ", "\n")), (5, long)]
    docs = awkward(spark, texts)
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in benchmark_matches(docs, bench).collect()}
    assert got == {(d, i, e) for d, e in ((1, 0), (None, 0), (4, 1)) for i in (1, 2)}
    spans = benchmark_matches(docs, bench).where("doc_id = 1").first()
    assert f"{long}{item}{long}"[spans["start"] : spans["end"]] == item
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == [2, 3, 5]
    assert benchmark_matches(docs, bench.limit(0)).count() == 0 and benchmark_matches(empty(spark), bench).count() == 0


def test_python_gets_batches_of_bounded_bytes(spark):
    setting, docs = "spark.sql.execution.arrow.maxBytesPerBatch", awkward(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    texts = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', 4000) AS text")
    for operator in (keep_one, lambda d: dedup_lines(d, build_index(d))):
        spark.conf.unset(setting)
        operator(docs)
        got = texts.mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r["n"] for r in got) == 3000 and max(r["bytes"] for r in got) < 2_000_000
    spark.conf.set(setting, "5m")  # a bound of the session's own stays
    keep_one(docs)
    assert spark.conf.get(setting) == "5m"
    spark.conf.unset(setting)


def test_the_word_cache_stays_small():
    before = shingles(" ".join(f"w{i}" for i in range(50)), 5)
    shingles(" ".join(f"word{i}" for i in range(250_000)), 5)
    shingles("z" * 1_000_000, 5)
    assert len(minhash._word_hashes) <= 100_000 and max(map(len, minhash._word_hashes)) <= 64
    assert shingles(" ".join(f"W{i}" for i in range(50)), 5).tolist() == before.tolist()
