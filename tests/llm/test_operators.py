"""The ten operators against brute force on a small fixture with edge cases."""

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewright.llm import bpe, common, op01_chat, op02_packing, op03_token_counts, op04_language_id, op05_pii, op06_exact_dedup, op07_mixing, op08_sharding, op09_jaccard_join, op10_embedding_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, run long, n long, size long, k string, cid long"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _rows():
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(300)]
    texts = [None, "", " \t\n", "one two", "One TWO", "a b c d e", "x" * 3000, "<|endoftext|> x  y\n\nz", "日本語 テスト 😀"]
    base = " ".join(rng.choice(vocabulary) for _ in range(120))
    texts += [base] * 5
    for i in range(12):  # near copies
        w = base.split()
        w[rng.randrange(len(w))] = "edit%d" % i
        texts.append(" ".join(w))
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts += [passage + " " + " ".join("u%d_%d" % (i, j) for j in range(60)) for i in range(10)]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 400))) for _ in range(40)]
    texts += [
        "mail a.b@c.example.com_d@e.f from 10.0.0.256 and 10.0.0.25, card 4539 1488 0343 6467, call +1 (555) 010-9999 or (555) 010-9999",
        "4539148803436467 4539148803436467", "1.2.3.4.5.6.7.8 +12 x@y z"
    ]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(9000)))
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s0"][i % 4], 0, 1, 2, 3, "k", 4) for i, t in enumerate(texts)]
    return rows + [rows[20], rows[1]]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_empty_tables(empty, spark):
    assert op02_packing.pack(empty).count() == 0
    assert op03_token_counts.token_counts(empty).count() == 0
    assert op04_language_id.identify(empty, op04_language_id.train(empty)).count() == 0
    assert op05_pii.find_pii(empty).count() == 0
    assert op06_exact_dedup.exact_dedup(empty).count() == 0
    assert op07_mixing.mix(empty).count() == 0
    assert op08_sharding.shard(empty).count() == 0
    assert op09_jaccard_join.jaccard_components(empty).count() == 0
    assert op10_embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert op01_chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_round_trip(spark):
    said = "</s>[INST] ok [/INST]"
    nasty = [said, r"<\s>", r"<\\s> [\HEAD] ", " [/HEAD]\nx", "<", "[", "\\", "", None, "plain", "<<SYS>>", "a</s", "</"]
    rows = [
        (c, t, ["user", "assistant", None, "</s>", "x [/HEAD]\ny"][t % 5], nasty[(c + t) % len(nasty)]) for c in range(13) for t in range(7)
    ]
    rows += [(None, 0, "user", "a"), (1, 0, "user", nasty[1]), (2, None, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = {r["conv_id"]: r for r in op01_chat.digests(op01_chat.format_chats(df)).collect()}
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(out) == set(want)
    for c, turns in want.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = out[c]
        assert r["round_trip"] and r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_token_counts_and_prefixes(docs, rows):
    want = Counter((r[0], len(TOKENIZER.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in op03_token_counts.token_counts(docs).collect()) == want
    rng = random.Random(2)
    parts = [
        "a", "the", " ", "  ", "\n", "'re", "'s", "'", "12", "!", "é", "中", "<|endoftext|>", "<|end", "\x1c", "\u3000", "\xa0", "\t", "😀",
        "don", "'ll", "a" * 60
    ]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        each = [len(TOKENIZER.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        blob = op03_token_counts.pack_counts(bpe.prefix_steps(text))
        assert op03_token_counts.unpack_counts(blob).tolist() == each == bpe.prefix_counts(text).tolist()
        assert each[op03_token_counts.longest_within(blob, 3)] <= 3


def test_packing_covers_every_id_once(docs, rows):
    ids = Counter()
    out = op02_packing.pack(docs).collect()
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
    repeats = Counter(r[0] for r in rows)
    for doc, text in {r[0]: r[1] for r in rows}.items():
        full = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]
        at = Counter()
        for r in by_doc[doc]:
            part = full[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(array("I", part).tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(full)
            at[r["start"]] += r["length"]
            ids[doc] += r["length"]
        assert ids[doc] == len(full) * repeats[doc]
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        end = 0
        for at, n in sorted(s):
            assert at == end
            end += n
        assert end <= 2048


def test_nnls_and_combinations():
    rng = np.random.default_rng(0)
    a = rng.random((20, 30))
    x = np.maximum(rng.normal(size=30), 0)
    got = op02_packing.nnls(a, a @ x)
    assert got.min() >= 0 and np.allclose(a @ got, a @ x, atol=1e-6)
    assert all(sum(c) == 12 and len(c) <= 3 for c in op02_packing.combinations(12, 3)) and len(op02_packing.combinations(12, 3)) == 19


def test_language_model_is_a_distribution_and_separates(spark):
    rng = random.Random(1)
    words = {"en": ["the", "and", "thing", "other"], "de": ["der", "und", "nicht", "über"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(30)), lang) for i in range(120) for lang in [("en", "de")[i % 2]]]
    df = spark.createDataFrame(
        rows + [(900, None, "en"), (901, "12 !?", "de"), (902, "xqzj qzxj kkqz wqxz", None)], "doc_id long, text string, lang string"
    )
    model = op04_language_id.train(df)
    context = op04_language_id.grams(op04_language_id.letters("the"))[-2] & np.uint64((1 << 48) - 1)
    symbols = np.arange(1 << 12, dtype=np.uint64)
    total = np.exp(model.score((context << np.uint64(16)) | symbols)).sum(axis=0)
    assert np.all(total <= 1.0001) and np.all(total > 0.9)
    out = {r["doc_id"]: r for r in op04_language_id.identify(df, model).collect()}
    assert all(out[i]["lang_pred"] == lang and out[i]["accepted"] for i, _, lang in rows)
    assert out[900]["lang_pred"] == out[901]["lang_pred"] == "und" and out[900]["score"] == 0
    assert not out[902]["accepted"] and out[902]["lang_pred"] in words


def test_few_training_documents_reject_no_clean_one(spark):
    rng = random.Random(9)
    letters = {"en": "etaoinshr", "de": "äöüßbgkmz", "fr": "éèçàvxjqw"}
    words = {k: ["".join(rng.choice(v) for _ in range(rng.randrange(2, 7))) for _ in range(400)] for k, v in letters.items()}
    text = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(40))
    train = [i for i in range(200) if not op04_language_id.is_held_out(i)]
    rows = [(i, text("en"), "en") for i in train[:60]] + [(i, text("de"), "de") for i in train[60:63]] + [(train[63], text("fr"), "fr")]
    new = [(1000 + i, text(lang), None) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    df = spark.createDataFrame(rows + new, "doc_id long, text string, lang string")
    model = op04_language_id.train(df)
    assert model.langs == ["de", "en", "fr"] and np.isfinite(model.limit[:2]).all() and np.isinf(model.limit[2])
    out = {r["doc_id"]: r for r in op04_language_id.identify(df, model).collect()}
    for i in range(60):
        assert out[1000 + i]["lang_pred"] == ["en", "de", "fr"][i % 3] and out[1000 + i]["accepted"]


def test_pii_base_spans(docs, rows):
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]"
    ]

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def base(text):
        out = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, text or ""):
                d = re.sub("[^0-9]", "", m.group())
                ok = [
                    True, k != 1 or all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15
                ][k]
                if ok:
                    out.append((m.start(), k, m.end()))
        return sorted(out)

    got = op05_pii.find_pii(docs).collect()
    text = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert [(s["start"], s["k"], s["end"]) for s in r["base"]] == base(text[r["doc_id"]])
    assert any(r["extra"] for r in got)


def _pii_base(text):
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]"
    ]
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = []
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            if [True, k != 1 or all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans_of_random_strings(spark):
    rng = random.Random(11)
    parts = [
        "a", "Z", "@", ".", "-", "+", "+1", " ", "  ", "(", ")", "0", "7", "25", "255", "256", "4539", "1488", "0343", "6467", "é", "😀",
        "_", "%", "a@b.c", "10.0.0.1"
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    out = op05_pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in out:
        assert [(s["start"], s["k"], s["end"]) for s in r["base"]] == _pii_base(texts[r["doc_id"]]), texts[r["doc_id"]]
        for e in r["extra"]:
            assert not [
                b for b in r["base"] if b["start"] < e["end"] and e["start"] < b["end"]
            ] and texts[r["doc_id"]][e["start"] : e["end"]] == e["hit"]


def test_pii_extras_are_found_and_decoys_left(spark):
    rng = random.Random(1)
    word = lambda: rng.choice("river stone light water under house other thing".split())
    some = lambda: " ".join(word() for _ in range(6))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(good, sep):
        while True:
            d = "4" + digits(15)
            if (sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0) == good:
                return sep.join(d[i : i + 4] for i in (0, 4, 8, 12))

    good = [
        lambda: f"{word()} (at) {word()} (dot) com", lambda: f"{word()} [at] {word()}.org", lambda: f"{word()}.{word()} at {word()} dot net", lambda: card(True, "."), lambda: card(True, "/"),
        lambda: f"({rng.randrange(200, 999)}) 555-{digits(4)}", lambda: f"{rng.randrange(200, 999)}-555-{digits(4)}", lambda: f"10[.]0[.]{rng.randrange(255)}[.]3",
    ]
    bad = [
        lambda: card(False, "."), lambda: card(False, "/"), lambda: f"order 055-123-{digits(4)}",
        lambda: f"310[.]400[.]{rng.randrange(255)}[.]3", lambda: f"{word()} at noon dot {word()}"
    ]
    rows = [
        (f"{some()} {f()} {some()}", True) for f in good for _ in range(25)
    ] + [(f"{some()} {f()} {some()}", False) for f in bad for _ in range(25)]
    rows += [(f"mail {word()}@{word()}.com or call +1 (555) 010-{digits(4)} card {card(i % 2 == 0, ' ')}", None) for i in range(50)]
    out = {
        r["doc_id"]: r for r in op05_pii.find_pii(
            spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
        ).collect()
    }
    hit = Counter((want, bool(out[i]["extra"])) for i, (_, want) in enumerate(rows) if want is not None)
    assert hit[True, True] >= 0.9 * (hit[True, True] + hit[True, False]) and hit[True, True] >= 0.9 * (hit[True, True] + hit[False, True])


def test_pii_of_a_long_text(spark):
    rng = random.Random(2)
    text = " ".join(f"{rng.randrange(10**5)}x (555) 010-{j % 10000:04d};" for j in range(30_000))
    out = op05_pii.find_pii(
        spark.createDataFrame([(1, text), (2, "1" * 200_000), (3, "1 " * 100_000), (4, "a@b." * 20_000)], "doc_id long, text string")
    ).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(got[1]["extra"]) == 30_000 and not got[2]["base"] and not got[3]["base"]
    assert [(s["start"], s["k"], s["end"]) for s in got[4]["base"]] == _pii_base("a@b." * 20_000)


def test_pii_phone_with_wide_gaps(spark):
    texts = ["+4  9  1  7  1  2  3  4  5", "+4 (9 (1 (7 (1 (2 (3 (4 (5", "+ 4  9", "call +1((2((3((4((5((6((7((8((9"]
    out = op05_pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: [(s["start"], s["k"], s["end"]) for s in r["base"]] for r in out}
    assert got == {0: [(0, 3, 26)], 1: [(0, 3, 26)], 2: [], 3: [(5, 3, len(texts[3]))]}


@pytest.mark.parametrize("digest", [None, lambda raw: hashlib.sha256(raw).digest()[:1] if len(raw) % 2 else b"\0"])
def test_exact_dedup(docs, rows, digest):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    text = {r[0]: r[1] or "" for r in rows}
    out = op06_exact_dedup.exact_dedup(docs, digest=digest).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    for r in out:
        g = groups[text[r["doc_id"]]]
        assert r["keep_id"] == max(g) and r["group_size"] == len(g)
    assert Counter(r["keep_id"] for r in out if r["kept"]) == Counter(max(g) for g in groups.values())


def test_exact_dedup_of_a_hot_text(spark, monkeypatch):
    monkeypatch.setattr(op06_exact_dedup, "MEMTABLE_ROWS", 4)
    monkeypatch.setattr(op06_exact_dedup, "TOGETHER", 3)
    rows = [(i, "hot" if i % 3 else f"t{i % 40}") for i in range(600)]
    weak = lambda raw: b"\0"  # noqa: E731 - all texts share one digest
    for digest in (None, weak):
        out = op06_exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), digest=digest).collect()
        groups = defaultdict(list)
        for i, t in rows:
            groups[t].append(i)
        text = dict(rows)
        assert len(out) == 600 and all(
            (r["keep_id"], r["group_size"]) == (max(groups[text[r["doc_id"]]]), len(groups[text[r["doc_id"]]])) for r in out
        )
        assert sorted(r["doc_id"] for r in out if r["kept"]) == sorted(max(g) for g in groups.values())


def test_sainte_lague_and_targets():
    rng = random.Random(3)
    for _ in range(50):
        w = [rng.randrange(0, 50) for _ in range(rng.randrange(1, 9))]
        seats, want = rng.randrange(0, 60), [0] * len(w)
        for _ in range(seats if sum(w) else 0):
            i = max(range(len(w)), key=lambda i: (w[i] / (2 * want[i] + 1), -i))
            want[i] += 1
        assert op07_mixing.sainte_lague(w, seats) == want
    t = op07_mixing.targets([100, 1000, 10, 0])
    assert sum(t) == pytest.approx(1.5 * 1110) and all(x <= 2 * s for x, s in zip(t, [100, 1000, 10, 0]))


def test_mixing(docs, rows):
    out = op07_mixing.mix(docs).collect()
    words = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    assert len(out) == len(rows)
    taken, target = Counter(), {}
    for r in out:
        assert r["size"] == words[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 16 for s in target)
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, op07_mixing.mix(docs).collect()), key=repr)


def test_shards_of_a_source_stay_few_and_small():
    for words in (0, 1, 10**5, 10**9, 10**13):
        n = op07_mixing.shard_count(words)
        assert 1 <= n <= max(1 << 13, 4 * 10**6) and words / n <= max(1 << 17, 4 * 10**6)


def _kd(rows, levels, tolerance):
    """The tree by sorting: (dims, hashes, size) rows; the shard of each."""
    total = sum(r[2] for r in rows)

    def grow(part, depth, n):
        if depth == levels:
            return {r[1]: n for r in part}
        extent = [max(r[0][d] for r in part) - min(r[0][d] for r in part) for d in range(3)]
        d = max(range(3), key=lambda i: (extent[i], -i))
        part = sorted(part, key=lambda r: (r[0][d], r[1]))
        half, run, cut = sum(r[2] for r in part) / 2, 0, 0
        while run + part[cut][2] < half:
            run, cut = run + part[cut][2], cut + 1
        options = [(abs(half - run), cut), (abs(run + part[cut][2] - half), cut + 1)]
        return {"off": min(options)[0] <= tolerance * total, "left": part, "half": half, "d": d}

    return grow(rows, 0, 0)


def test_sharding_cuts_the_widest_dimension_at_the_median(spark):
    rng = random.Random(4)
    rows = [
        (
            i, " ".join("".join(rng.choice("abcé語") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 80)))
        ) for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    meta = op08_sharding._scaled(op08_sharding._metadata(df, "doc_id", "text")).collect()
    first = _kd([([r[d] for d in op08_sharding.DIMS], r["hashes"], r["size"]) for r in meta], 1, op08_sharding.TOLERANCE / 2)
    dim = op08_sharding.DIMS[first["d"]]
    place = {r["doc_id"]: r["shard"] for r in op08_sharding.shard(df, levels=1).collect()}
    low, high = [[(r[dim], r["hashes"]) for r in meta if place[r["k"]] == s] for s in (0, 1)]
    assert max(low) < min(high)
    assert abs(sum(r["size"] for r in meta if place[r["k"]] == 0) - first["half"]) <= 2 * op08_sharding.TOLERANCE * first["half"]
    # further levels cut each part again, and target bytes ask for as many as needed
    deep = {r["doc_id"]: r["shard"] for r in op08_sharding.shard(df, target_bytes=-(-sum(r["size"] for r in meta) // 7)).collect()}
    assert set(deep.values()) == set(range(8))
    assert len({s >> 2 for s in deep.values()}) == 2
    two = {r["doc_id"]: r["shard"] for r in op08_sharding.shard(df, levels=2).collect()}
    assert all(two[i] >> 1 == place[i] for i in place)


def test_sharding_keeps_equal_texts_together_and_cuts_a_hot_group(spark):
    rng = random.Random(6)
    rows = [(i, f"copy {i % 150} " * 4) for i in range(600)] + [
        (1000 + i, "".join(rng.choice("abc ") for _ in range(200))) for i in range(3000)
    ]
    hot = [(9000 + i, "hot " * 40) for i in range(2000)]
    odd = [(None, "null id"), (None, "null id"), (5, rows[5][1]), (7777, None), (7778, "")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows + hot + odd], "doc_id long, text string, size long, node string, hashes int")
    out = op08_sharding.shard(df).collect()
    assert len(out) == len(rows + hot + odd) and out[0].asDict().keys() == {
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    }
    text, home, total = dict(rows + hot), defaultdict(set), Counter()
    for r in out:
        total[r["shard"]] += r["size"]
        if r["doc_id"] in text:
            home[text[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for t, s in home.items() if not t.startswith("hot")) and len(home["hot " * 40]) > 2
    assert max(total.values()) < 1.1 * min(total.values())


def test_sharding(spark):
    rng = random.Random(8)
    rows = [
        (
            i, None if i == 3 else "copy " * 50 if i % 3 == 0 else "".join(rng.choice("abc é") for _ in range(rng.randrange(0, 400)))
        ) for i in range(3000)
    ]
    out = op08_sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    total, slots = Counter(), defaultdict(list)
    for r in out:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(total) == set(range(16)) and max(total.values()) < 1.06 * min(total.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_jaccard_components(docs, rows):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = roots(ids, links)
    out = op09_jaccard_join.jaccard_components(docs).collect()
    assert Counter(
        (r["doc_id"], r["n_shingles"], r["component_id"]) for r in out
    ) == Counter((r[0], len(sets[r[0]]), want[r[0]]) for r in rows)


def _sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("digest", [lambda raw: len(raw) % 5, lambda raw: (len(raw) << 64) | (sum(raw) % 3)])
def test_jaccard_classes_that_share_a_name_are_parted(docs, rows, monkeypatch, digest):
    """Names of a few values: every join by name would merge documents that differ, were they not told apart."""
    sets = {r[0]: _sets(r[1]) for r in rows}
    whole = op09_jaccard_join._digest
    weak = lambda raw: (whole(raw) >> 64 << 64) | digest(raw) & ((1 << 64) - 1)
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = roots(ids, links)
    out = op09_jaccard_join.jaccard_components(docs, digest=weak).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in out) == Counter((r[0], want[r[0]]) for r in rows)


def test_jaccard_with_heavy_tokens_and_busy_leaders(spark, monkeypatch):
    for name, value in (("HEAVY", 2), ("MEMTABLE_ROWS", 16), ("SHARD_TOKENS", 200), ("LEAD_ROWS", 3), ("BAND_ROWS", 4)):
        monkeypatch.setattr(op09_jaccard_join, name, value)
    rng = random.Random(12)
    words = ["v%d" % i for i in range(200)]
    base = [[rng.choice(words) for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(240):
        w = list(base[i % 6])
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(60)] = "e%d" % rng.randrange(1000)
        rows.append((i, " ".join(w)))
    sets = {i: _sets(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = roots(sorted(sets), links)
    df = spark.createDataFrame(
        [(*r, 1, "b", 2, 3) for r in rows], "doc_id long, text string, n long, sig string, run long, cid int"
    ).repartition(3)
    out = op09_jaccard_join.jaccard_components(df).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want


def test_embedding_blocks_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(op10_embedding_dedup, "TILE", 32)
    monkeypatch.setattr(op10_embedding_dedup, "SMALL", 4)
    monkeypatch.setattr(op10_embedding_dedup, "MEMTABLE_ROWS", 64)
    rng = np.random.default_rng(8)
    center = rng.normal(size=24)
    rows = [(i, [float(np.float32(x)) for x in center + rng.normal(size=24) * 0.11], "a") for i in range(300)]
    rows += [
        (1000 + i, [float(np.float32(x)) for x in rng.normal(size=24)], "a") for i in range(100)
    ] + [(5, rows[5][1], "a"), (None, rows[6][1], "a")]
    df = spark.createDataFrame(
        [(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<float>, label string, band long, key string, n long"
    )
    out = Counter((r["vec_id"], r["n_links"]) for r in op10_embedding_dedup.embedding_dedup(df.repartition(3)).collect())
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert out == Counter((r[0], int(k)) for r, k in zip(rows, n)) and n.max() > 50


def test_embedding_dedup(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 16))
    rows = []
    for i in range(400):
        v = base[i % 30] + rng.normal(size=16) * (0.08 if i % 2 else 0.3)
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    rows += [(500 + i, rows[7][1], rows[7][2]) for i in range(50)]
    rows += [
        (600, None, 0), (601, [0.0] * 16, 0), (602, [1.0, None] * 8, 0), (603, [float("nan")] * 16, 0), (604, rows[7][1], None),
        (605, [1.0, 2.0], 0), (606, [], 0), (607, [2.0, 4.0], 0)
    ]
    out = {
        r["vec_id"]: r for r in op10_embedding_dedup.embedding_dedup(
            spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
        ).collect()
    }
    ok = [(i, np.array(v, float), k) for i, v, k in rows if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [
        (a, b) for a, x, k in ok for b, y,
        m in ok if a != b and k == m and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98
    ]
    n, want = Counter(a for a, _ in links), roots([r[0] for r in rows], links)
    assert len(out) == len(rows)
    found = sum(r["n_links"] for r in out.values())
    assert found == len(links)
    for i, r in out.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (n[i], want[i], want[i] == i)


def test_no_python_in_native_plans(docs, spark):
    chats = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for df in (op01_chat.digests(op01_chat.format_chats(chats)), op05_pii.find_pii(docs), op08_sharding.shard(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
    assert F is not None


def test_jaccard_shingles_equal_word_tuples():
    def brute(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    texts = [row[1] for row in _rows()] + [
        "a\x0bB\x1fc  d", "é É x y z w", "x" * 300_000 + " y z", ("w " * 5 + "q") * 60_000, "A" * 33 + " b c d e", "a" * 33 + " b c d e"
    ]
    for text in texts:
        assert len(op09_jaccard_join.shingles(text)) == len(brute(text))
    for a in texts:
        for b in texts:
            if len(a or "") < 1000 and len(b or "") < 1000:
                both = np.intersect1d(op09_jaccard_join.shingles(a), op09_jaccard_join.shingles(b))
                assert len(both) == len(brute(a) & brute(b))


def test_jaccard_shingles_do_not_depend_on_blocks(monkeypatch):
    text = " ".join("word%d\n" % (i % 977) for i in range(20_000))
    whole = op09_jaccard_join.shingles(text)
    monkeypatch.setattr(op09_jaccard_join, "BLOCK", 64)
    assert (op09_jaccard_join.shingles(text) == whole).all()


def test_jaccard_parities_never_exclude_a_link():
    rng = np.random.default_rng(3)
    for _ in range(1500):
        a = np.unique(rng.integers(0, 1 << 64, int(rng.integers(1, 900)), dtype=np.uint64))
        b = np.unique(
            np.concatenate([a[: int(rng.integers(1, len(a) + 1))], rng.integers(0, 1 << 64, int(rng.integers(0, 300)), dtype=np.uint64)])
        )
        differ = op09_jaccard_join._differ(op09_jaccard_join._parity(a), op09_jaccard_join._parity(b))
        assert differ <= len(np.setxor1d(a, b))
        if op09_jaccard_join.linked(a, b):
            assert 7 * differ <= len(a) + len(b)


def test_prefix_store_answers_budgets(spark, docs, rows):
    store = op03_token_counts.prefix_store(docs)
    blob = {r["doc_id"]: r["prefix_counts"] for r in store.collect()}
    rng = random.Random(3)
    count = lambda t: len(TOKENIZER.encode(t, add_special_tokens=False).ids)
    for i, text in {r[0]: r[1] or "" for r in rows}.items():
        n = op03_token_counts.unpack_counts(blob[i])
        assert len(n) == len(text) + 1 and n[-1] == count(text) == op03_token_counts.total(blob[i])
        for _ in range(3):
            at = rng.randrange(len(text) + 1)
            assert op03_token_counts.count_at(blob[i], at) == count(text[:at])
    for limit in (0, 5, 50):
        for r in op03_token_counts.answers(store, limit).collect():
            n = op03_token_counts.unpack_counts(blob[r["doc_id"]])
            assert r["over_limit"] == (n[-1] > limit) and r["chars_within"] == max(k for k, x in enumerate(n) if x <= limit)


def test_packing_places_by_plan_and_pads_little(spark):
    rng = random.Random(7)
    rows = [(i, " ".join("w%d" % rng.randrange(99) for _ in range(rng.randrange(20, 1500)))) for i in range(400)]
    out = op02_packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    used = Counter()
    for r in out:
        used[r["sequence_id"]] += r["length"]
    assert sum(used.values()) >= 0.97 * 2048 * len(used)
    assert sum(r["sequence_id"] % 4 == 1 for r in out) > 0.5 * sum(r["sequence_id"] % 4 != 0 for r in out)
    plan = op02_packing.plan({32: 100, 64: 50, 96: 100, 128: 3})
    assert sum(n for c, n in plan if c == (128,)) == 3 and sum(n * len(c) for c, n in plan) > 200


def test_language_sample_is_bounded_whatever_the_ties(spark, monkeypatch):
    monkeypatch.setattr(op04_language_id, "TRAIN_DOCS", 20)
    ids = [i for i in range(4000) if not op04_language_id.is_held_out(i)]
    rows = [(ids[0], "the same id and text", "en")] * 500 + [
        (ids[1], f"the same id {i}", "en") for i in range(500)
    ] + [(i, f"und der text {i}", "de") for i in ids[:300]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, score long, k string")
    got = Counter(r["lang"] for r in op04_language_id._sample(df, "doc_id", "text", "lang").collect())
    assert 0 < got["en"] <= 20 and got["de"] == 20
    model = op04_language_id.train(df)
    assert model.langs == ["de", "en"]
    out = op04_language_id.identify(df, model).collect()
    assert len(out) == len(rows) and all(r["lang_pred"] == ("de" if i >= 1000 else "en") for i, r in enumerate(out))
    long = spark.createDataFrame([(1, "the same text " * 50_000, None), (2, "", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in op04_language_id.identify(long, model).collect()] == ["en", "und"]
    tie = op04_language_id.Model({"b": op04_language_id.gram_counts(["aaa"]), "a": op04_language_id.gram_counts(["aaa"])})
    assert op04_language_id.identify(df.limit(1), tie).first()["lang_pred"] == "a"


def test_sparse_model_equals_a_model_of_one_language():
    texts = {"en": ["the other thing", "and the rest"], "de": ["der andere und", "nicht über"]}
    both = op04_language_id.Model({k: op04_language_id.gram_counts(t) for k, t in texts.items()})
    q = op04_language_id.grams(op04_language_id.letters("the und über zzz other"))
    for j, lang in enumerate(both.langs):
        alone = op04_language_id.Model({lang: op04_language_id.gram_counts(texts[lang])})
        assert np.allclose(both.score(q)[:, j], alone.score(q)[:, 0], atol=1e-5)


def test_chat_of_long_texts_and_extra_columns(spark):
    said = "</s>[INST]" * 20_000
    df = spark.createDataFrame(
        [(1, 0, "user", said, 5, "z"), (1, 1, "assistant", "x" * 500_000, 6, "y")],
        "conv_id long, turn long, role string, text string, i int, plain string"
    )
    r = op01_chat.digests(op01_chat.format_chats(df)).first()
    assert r["round_trip"] and r["n_turns"] == 2 and r["loss_chars"] == 500_000
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{'x' * 500_000}\n".encode()).hexdigest()


def test_membership_filter_and_components(spark, monkeypatch):
    df = spark.range(5000).withColumnRenamed("id", "k")
    some = spark.range(0, 5000, 7)
    got = common.maybe_in(df, "k", some)
    assert got.join(some, F.col("k") == F.col("id")).count() == some.count() and got.count() < 1500
    monkeypatch.setattr(common, "FILTER_MOST", 2)
    assert common.maybe_in(df, "k", some).count() == 5000
    links = [(i, i + 1) for i in range(0, 200) if i % 50 != 49] + [(500, 900), (900, 500), (7, 7)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == i - i % 50 for i in range(200)) and got[900] == 500
