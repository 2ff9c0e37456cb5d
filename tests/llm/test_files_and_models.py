"""Resharding, token files, pseudonyms and the classifier."""

import datetime as dt
import hashlib
import itertools
import os
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabflow.llm import pseudonyms
from tabflow.llm.common import materialize, scratch_path
from tabflow.llm.pseudonyms import feistel, pseudonymize
from tabflow.llm.quality_classifier import score, train, training_rows, words_of
from tabflow.llm.resharding import equal_capacities, min_cost_flow, moving_cost, reshard, slots, write_layout
from tabflow.llm.token_files import FileBuilder, file_offsets, frame_ids, read_tokens, seek_table, write_tokens
from tests.llm.fixtures import TOKENIZER, awkward, empty

SF = "/root/testdata/sf0.01"


def _cheapest(supply, capacity, cost):
    states = {tuple(capacity): 0.0}
    for i in [i for i, n in enumerate(supply) for _ in range(n)]:
        after = {}
        for room, paid in states.items():
            for j in range(len(capacity)):
                if room[j]:
                    key = (*room[:j], room[j] - 1, *room[j + 1 :])
                    after[key] = min(after.get(key, np.inf), paid + cost[i, j])
        states = after
    return min(states.values())


def test_flow_is_the_cheapest():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, m = rng.integers(1, 4, 2)
        supply, capacity = rng.integers(0, 4, n).tolist(), rng.integers(0, 5, m).tolist()
        capacity[0] += max(0, sum(supply) - sum(capacity))
        cost = rng.integers(0, 4, (n, m)).astype(float)
        flow = min_cost_flow(supply, capacity, cost)
        assert flow.sum(1).tolist() == supply and (flow.sum(0) <= capacity).all() and (flow >= 0).all()
        assert (flow * cost).sum() == pytest.approx(_cheapest(supply, capacity, cost))
    with pytest.raises(ValueError, match="cannot hold"):
        min_cost_flow([3], [2], moving_cost(1, 1))


def test_resharding_evens_bytes_and_keeps_unaffected_files(spark):
    rng = random.Random(1)
    texts = [(i, "x" * rng.randint(0, 400)) for i in range(400)] + [(None, "null id"), (400, None), (7, "again"), (7, "again")]
    docs = awkward(spark, texts).repartition(6)
    size = lambda t: len((t or "").encode()) + 1
    old = F.when(F.col("doc_id") < 200, 0).when(F.col("doc_id") < 230, 1).otherwise(2)
    layout = write_layout(docs, old, scratch_path(spark, "test-old"))
    new = reshard(layout, 4, 3)
    placed = slots(new).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in placed) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in texts
    )
    shards, numbers = Counter(), defaultdict(list)
    for r in placed:
        shards[r["shard"]] += r["size"]
        numbers[r["shard"]].append(r["slot"])
    total = sum(shards.values())
    assert set(shards) == set(range(4)) and all(sorted(x) == list(range(len(x))) for x in numbers.values())
    assert all(abs(shards[j] - c) <= 401 for j, c in enumerate(equal_capacities(total, 4)))
    # files that stay are those of the old layout, and hardly more bytes move than must
    held = {r["_file"] for r in layout.read().select("_file").distinct().collect()}
    assert held & {r["_file"] for r in new.read().select("_file").distinct().collect()}
    before = Counter()
    for r in layout.read().select("shard", "size").collect():
        before[r["shard"]] += r["size"]
    least = sum(max(0, before[j] - c) for j, c in enumerate(equal_capacities(total, 4)))
    moved = new.read().where(~F.col("_file").isin(*held)).agg(F.sum("size")).first()[0]
    assert moved <= total and least > 0
    # a second resharding starts from the mixed layout; one with equal capacities again moves nothing much
    again = reshard(new, 4, 4)
    assert Counter(r["doc_id"] for r in slots(again).collect()) == Counter(i for i, _ in texts)
    with pytest.raises(ValueError, match="outside"):
        reshard(layout, 4, 2)


def test_resharding_an_empty_layout(spark):
    layout = write_layout(empty(spark), F.lit(0), scratch_path(spark, "test-empty"))
    assert slots(reshard(layout, 4, 3)).count() == 0


def _tokens(docs):
    plain = Tokenizer.from_file(TOKENIZER)
    return [(r["doc_id"], [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0]) for r in docs.collect()]


def test_token_files_round_trip(spark):
    docs = materialize(awkward(spark), "test-docs")
    path = scratch_path(spark, "test-tokens")
    write_tokens(docs, path, TOKENIZER, 0)
    got = read_tokens(spark, path).join(file_offsets(spark, path), "file").collect()
    want = _tokens(docs)
    assert Counter((r["doc_id"], r["ids"]) for r in got) == Counter((i, np.array(x, "<u4").tobytes()) for i, x in want)
    at = 0
    for r in sorted(got, key=lambda r: r["file_start"] + r["start_in_file"]):
        assert r["file_start"] + r["start_in_file"] == at and r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
    in_order = [r["doc_id"] for r in sorted(got, key=lambda r: r["file_start"] + r["start_in_file"])]
    assert in_order == sorted(in_order, key=lambda i: (i is not None, i or 0))
    assert {r["doc_id"] for r in read_tokens(spark, path, [3, 7, 99]).collect()} == {3, 7}
    nothing = scratch_path(spark, "test-tokens")
    write_tokens(empty(spark), nothing, TOKENIZER, 0)
    assert read_tokens(spark, nothing).count() == 0 and file_offsets(spark, nothing).count() == 0


def test_a_file_is_plain_zstandard_and_tells_damage():
    import zstandard

    builder, all_ids = FileBuilder(), [np.arange(n, dtype="<u4").tobytes() for n in (1, 5000, 3)]
    for doc_id, ids in zip((None, 4, 9), all_ids, strict=True):
        builder.add(doc_id, ids)
    content = builder.content() + b"\n"
    table = seek_table(content)
    assert [t[0] for t in table] == [None, 4, 9] and [frame_ids(content, *t[1:]) for t in table] == all_ids
    reader = zstandard.ZstdDecompressor().stream_reader(content[:-1], read_across_frames=True)
    assert reader.read() == b"".join(all_ids)  # any reader skips the tables
    # one frame can be read while another is damaged
    spoiled = bytearray(content)
    spoiled[table[1][1] + 12] ^= 255
    assert frame_ids(bytes(spoiled), *table[2][1:]) == all_ids[2]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        frame_ids(bytes(spoiled), *table[1][1:])
    with pytest.raises(ValueError, match="seekable"):
        seek_table(content[:-1] + b"x")


def _luhn(number):
    digits = [int(c) for c in reversed(number) if c.isdigit()]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def _one(spark, text, key="k"):
    return pseudonymize(awkward(spark, [(1, text)]), key).first()


def test_pseudonyms_keep_formats_and_links(spark):
    cards = ["4845168114407329", "4845-1681-1440-7329", "4845 1681 1440 7329"]
    values = [*cards, "+1 (017) 555-7713", "97.51.17.173", "2021-02-28", "28.02.2021", "12/31/1999", "31/12/1999"]
    values += ["123-45-6789", "Und.34@mail7.example.com", "a@b.co"]
    shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d+", "9", s)))
    got = _one(spark, " | ".join(values) + "!!")
    out = got["text"].removesuffix("!!").split(" | ")
    assert got["n_replaced"] == len(values) and len(out) == len(values)
    for value, new in zip(values, out, strict=True):
        assert new != value and shape(new) == shape(value)
    assert all(_luhn(c) for c in out[:3])
    assert all(int(x) < 256 for x in out[4].split("."))
    for new, style in zip(out[5:9], ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", "%d/%m/%Y"), strict=True):
        assert 1700 <= dt.datetime.strptime(new, style).year <= 2099
    again = pseudonymize(awkward(spark, [(2, f"x {values[0]}, and"), (3, f"{values[3]}%%%")]), "k").orderBy("doc_id").collect()
    assert again[0]["text"] == f"x {out[0]}, and" and again[1]["text"] == f"{out[3]}%%%"
    assert _one(spark, values[0], "another key")["text"] != out[0]


def test_what_is_not_valid_is_left_alone(spark):
    for text in (
        "4845168114407328", "300.1.1.1", "1.2.3.4.5", "version 4.0.", "30.02.2021", "2021-13-01", "1500-01-01", "999-45-6789",
        "123-00-6789", "4845168114407329a", "no numbers", "a @ b.co", "12345678", "", " 9 9 9 ",
    ):
        got = _one(spark, text)
        assert (got["text"], got["n_replaced"]) == (text, 0)
    assert tuple(_one(spark, None)) == (1, None, 0)
    long = "word " * 20000 + "97.51.17.173" + " word" * 20000
    assert len(_one(spark, long)["text"]) - len(long) in range(-8, 4) and _one(spark, long)["n_replaced"] == 1
    assert pseudonymize(empty(spark), "k").count() == 0
    assert pseudonymize(awkward(spark), "k").where("n_replaced >= 0").count() == awkward(spark).count()


def test_cards_beside_other_digits_are_found(spark):
    card, grouped, other = "4845168114407329", "4845 1681 1440 7329", "378282246310005"
    values = ["2021-02-28", "12/31/1999", "123-45-6789", "97.51.17.173", "12@mail7.example.com"]
    beside = [
        f"{card} 123", f"{grouped} 12/27", f"12 {card}", f"2 {grouped}", f"12345 {grouped}", f"{card}-12",
        f"{grouped} {grouped}", f"7 {grouped} 1234 {grouped} 99", f"{card} 12/27 123", f"17 {other} 9", f"{grouped} 12x",
    ]
    mixed = [f"{card} {v}" for v in values]
    row = " ".join(["0000000001"] * 300) + f" . {card}"  # a long row of groups before a card
    texts = [card, grouped, other, *values, *beside, *mixed, row]
    found = pseudonymize(awkward(spark, list(enumerate(texts))), "k").collect()
    got = {texts[r["doc_id"]]: (r["text"], r["n_replaced"]) for r in found}
    for text in beside:
        new, n = got[text]
        assert not any(c in new for c in (card, grouped, other)) and n >= 1
        assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", text)
    for text in (f"{card} 123", f"2 {grouped}", f"{card}-12", f"{grouped} {grouped}"):
        want = text
        for c in (card, grouped):
            want = want.replace(c, got[c][0])
        assert got[text] == (want, text.count("7329"))
    # values of other kinds after a card are still found
    for value, text in zip(values, mixed, strict=True):
        assert got[text] == (f"{got[card][0]} {got[value][0]}", 2) and got[value][0] != value
    assert got[row][0].endswith(f" . {got[card][0]}")


def test_timestamps_and_phone_formats_are_found(spark):
    card = "4845168114407329"
    phones = ["555-123-4567", "(555) 123-4567", "555.123.4567", "+33 1 42 68 53 00", "01 42 68 53 00", "+1 (017) 555-7713"]
    texts = ["2021-03-04", "2021-03-04T10:00:00Z", *phones, card, f"{card} {phones[0]}", f"{phones[0]}, {phones[1]}."]
    texts += ["2021-13-04T10:00:00Z", "555-123-45678", "1.555.123.4567", "a555-123-4567", "2021-03-04Tx"]
    got = {texts[r["doc_id"]]: r for r in pseudonymize(awkward(spark, list(enumerate(texts))), "k").collect()}
    assert got[texts[1]]["text"] == got[texts[0]]["text"] + "T10:00:00Z" and got[texts[1]]["n_replaced"] == 1
    for phone in phones:
        assert got[phone]["text"] != phone and got[phone]["n_replaced"] == 1
        assert re.sub(r"\d", "9", got[phone]["text"]) == re.sub(r"\d", "9", phone)
    assert got[phones[3]]["text"].startswith("+33 ") and got[phones[4]]["text"].startswith("0")
    assert got[texts[9]]["text"] == f"{got[card]['text']} {got[phones[0]]['text']}" and got[texts[9]]["n_replaced"] == 2
    assert got[texts[10]]["text"] == f"{got[phones[0]]['text']}, {got[phones[1]]['text']}."
    assert all((got[t]["text"], got[t]["n_replaced"]) == (t, 0) for t in texts[11:])


def test_feistel_is_a_permutation(spark):
    for radices in ((7, 5), (3, 2, 4), (6,), (2, 1, 3, 2)):
        every = [list(x) for x in itertools.product(*map(range, radices))]
        frame = spark.createDataFrame([(x,) for x in every], "x array<int>")
        moved = frame.select(feistel(F.col("x"), F.array(*map(F.lit, radices)), "k", "t")).collect()
        assert sorted(list(r[0]) for r in moved) == sorted(every)
    assert pseudonyms.DAY_RADICES[0] * pseudonyms.DAY_RADICES[1] == (dt.date(2100, 1, 1) - dt.date(1700, 1, 1)).days


def test_pseudonyms_plan_has_no_python(spark):
    plan = pseudonymize(awkward(spark), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_classifier_without_labels_of_both_classes(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in score(docs, train(training_rows(docs, none, "quality", F.lit(True)))).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1), (77, 1), (3, None), (None, 1)], "doc_id long, quality int")
    model = train(training_rows(docs, ones, "quality", F.lit(True)))
    got = score(docs, model).collect()
    assert len(got) == docs.count() and all(0.99 < r["score"] <= 1 for r in got)
    assert score(empty(spark), model).count() == 0


def test_repetition_becomes_a_word():
    assert len(words_of("a a b")) == 4 and len(words_of("a b\na b")) == 5 and words_of(None) == words_of(" \n") == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    rows = training_rows(docs, labels, "quality", ~held, per_class=200)
    assert len(rows) <= 400 and all(r[3].sum() == pytest.approx(1, abs=1e-3) for r in rows)
    scored = score(docs, train(rows)).join(labels.where(held), "doc_id").collect()
    right = sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in scored)
    assert right / len(scored) > 0.95


def _plain_feistel(symbols, radices, kind, key="k"):
    """The permutation in plain Python."""
    now, half = list(symbols), len(symbols) / 2
    for round_ in range(pseudonyms.ROUNDS):
        left = round_ % 2 == 0
        other = ",".join(str(x) for i, x in enumerate(now) if (i < half) != left)
        digest = hashlib.sha256(f"{key}|{kind}|{round_}|{other}".encode()).hexdigest()
        shift = [int(digest[i * 4 % 64 :][:4], 16) for i in range(len(now))]
        now = [(x + shift[i]) % radices[i] if (i < half) == left else x for i, x in enumerate(now)]
    return now


def _plain_digits(digits, kind):
    return "".join(map(str, _plain_feistel([int(d) for d in digits], [10] * len(digits), kind)))


def _relaid(layout, digits):
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in layout)


def _plain_pseudonym(value):
    digits = re.sub(r"\D", "", value)
    if "@" in value:
        local, host = re.fullmatch(r"(.*?)((?:(?<=@)|\.)[^@.]+\.[^@.]+)", value).groups()
        base = [48 if c.isdigit() else 97 if c.islower() else 65 if c.isupper() else None for c in local]
        symbols = [ord(c) - b if b else 0 for c, b in zip(local, base, strict=True)]
        moved = _plain_feistel(symbols, [{48: 10, None: 1}.get(b, 26) for b in base], "email")
        return "".join(chr(b + m) if b else c for c, b, m in zip(local, base, moved, strict=True)) + host
    if re.fullmatch(r"[\d.]+", value) and value.count(".") == 3:
        return ".".join(map(str, _plain_feistel([int(x) for x in value.split(".")], [256] * 4, "ipv4")))
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", value):
        areas = [a for a in range(1, 900) if a != 666]
        a, g, n = (int(x) for x in value.split("-"))
        a, g, n = _plain_feistel([areas.index(a), g - 1, n - 1], [898, 99, 9999], "ssn")
        return f"{areas[a]:03}-{g + 1:02}-{n + 1:04}"
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        day = (dt.date.fromisoformat(value) - dt.date(1700, 1, 1)).days
        low, high = _plain_feistel([day % 189, day // 189], [189, 773], "date")
        return str(dt.date(1700, 1, 1) + dt.timedelta(days=low + 189 * high))
    if len(digits) >= 13:
        body = _plain_digits(digits[:-1], "card")
        check = next(str(c) for c in range(10) if _luhn(f"{body}{c}"))
        return _relaid(value, body + check)
    code = "+1" if value.startswith("+1") else ""
    return code + _relaid(value[len(code) :], _plain_digits(digits[len(code) and 1 :], "phone"))


def test_pseudonyms_equal_plain_python(spark):
    rng = random.Random(4)
    card = lambda: next(c for c in (f"4{rng.randrange(10**15):015}" for _ in itertools.count()) if _luhn(c))
    values = []
    for _ in range(25):
        c, p = card(), f"{rng.randrange(2, 10)}{rng.randrange(10**9):09}"
        values += [c, "-".join(re.findall("....", c)), f"{p[:3]}-{p[3:6]}-{p[6:]}", f"({p[:3]}) {p[3:6]}-{p[6:]}"]
        values += [f"+1 {p[:3]} {p[3:6]} {p[6:]}", ".".join(str(rng.randrange(256)) for _ in range(4))]
        values += [f"{rng.choice([1, 665, 667, 899, 123]):03}-{rng.randrange(1, 100):02}-{rng.randrange(1, 10000):04}"]
        values += [str(dt.date(1700, 1, 1) + dt.timedelta(days=rng.randrange(146097)))]
        values += [f"{rng.choice('abXY')}.{rng.randrange(99)}_b%c@mail.ex{rng.randrange(9)}.org"]
    docs = [(k, f"see {v} and {w}; end") for k, (v, w) in enumerate(zip(values, values[::-1], strict=True))]
    got = pseudonymize(awkward(spark, docs), "k").collect()
    for r in got:
        v, w = values[r["doc_id"]], values[::-1][r["doc_id"]]
        assert r["text"] == f"see {_plain_pseudonym(v)} and {_plain_pseudonym(w)}; end"


def test_values_stay_linked_in_every_layout(spark):
    cards = ["4845168114407329", "4845 1681 1440 7329", "4845-1681-1440-7329"]
    phones = ["555-123-4567", "(555) 123-4567", "555.123.4567"]
    texts = cards + phones + ["ann.b@x.org", "..ann.b@x.org"]
    got = [r["text"] for r in pseudonymize(awkward(spark, list(enumerate(texts))), "k").orderBy("doc_id").collect()]
    assert len({re.sub(r"\D", "", t) for t in got[:3]}) == 1 and len({re.sub(r"\D", "", t) for t in got[3:6]}) == 1
    assert got[7] == ".." + got[6] != texts[7]


def test_social_security_numbers_stay_valid_and_apart(spark):
    rng = random.Random(5)
    values = {f"{a:03}-{rng.randrange(1, 100):02}-{rng.randrange(1, 10000):04}" for a in range(1, 900) if a != 666}
    made = [r["text"] for r in pseudonymize(awkward(spark, list(enumerate(sorted(values)))), "k").collect()]
    assert len(set(made)) == len(values)
    assert not any(re.search(r"^(?:000|666|9)|-00-|-0000$", m) for m in made)


def test_a_megabyte_word_is_read_once(spark):
    long = "aZ" * 500_000
    texts = [f"{long}7 a@b.co", f"{long}7@", "a." * 500_000 + "7", "a@" + "b." * 200_000 + "7", "x@b.com."]
    start = time.monotonic()
    got = {r["doc_id"]: r for r in pseudonymize(awkward(spark, list(enumerate(texts))), "k").collect()}
    assert time.monotonic() - start < 60
    assert got[0]["n_replaced"] == got[4]["n_replaced"] == 1 and got[4]["text"].endswith("@b.com.")
    assert got[1]["text"] == texts[1] and got[2]["text"] == texts[2]
