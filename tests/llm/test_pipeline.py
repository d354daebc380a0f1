"""The pipeline's stages on a small table."""

import random
from collections import Counter

import pytest

import corpus_pipeline


def test_pipeline(spark, tmp_path):
    rng = random.Random(6)
    words = ["the", "and", "thing", "other", "house", "river", "stone", "light", "water", "under"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)), "en", f"s{i % 3}") for i in range(60)]
    near = rows[5][1].split()
    near[-1] = "changed"
    rows += [(100, rows[4][1], "en", "s0"), (101, " ".join(near), "en", "s1"), (102, "123 !!", "en", "s1"), (103, None, None, None)]
    docs = spark.createDataFrame(
        [(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "test")
        seen.append(docs)
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert ids[0] == {r[0] for r in rows} - {102, 103}
    assert ids[1] == ids[0] - {4}
    assert ids[2] == ids[1] - {101}
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars"] for d in seen[:4])
    words_in = sum(len(r["text"].split()) for r in seen[2].collect())
    assert abs(sum(len(r["text"].split()) for r in seen[3].collect()) - 1.5 * words_in) < 100
    assert seen[4].count() and corpus_pipeline.run(spark, str(tmp_path)).count()


def _texts(n, seed):
    rng = random.Random(seed)
    return [" ".join("w%d" % rng.randrange(300) for _ in range(60)) for _ in range(n)]


def _near(text):
    return text.rsplit(" ", 1)[0] + " changed"


def _frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    ).repartition(3)


def _left(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_null_and_repeated_ids_stay(spark):
    a, b, c, d, e, f, g, h = _texts(8, 1)
    rows = [(None, a), (None, b), (None, b), (None, c), (3, c), (7, d), (7, e), (7, e), (0, f)]
    want = [(None, a), (None, b), (3, c), (7, d), (7, e), (0, f)]
    once = corpus_pipeline.materialize(corpus_pipeline.distinct_texts(spark, _frame(spark, rows), ""), "test")
    assert _left(once) == Counter(want)
    assert _left(corpus_pipeline.distinct_near_texts(spark, once, "")) == Counter(want)
    # a near copy of another document goes, whatever else has its id; null goes before any id, and 0 is no null
    rows = want + [(3, _near(a)), (7, _near(f)), (None, _near(d)), (None, g), (0, _near(g)), (None, h), (None, _near(h))]
    out = _left(corpus_pipeline.distinct_near_texts(spark, _frame(spark, rows), ""))
    assert {k for k in out if k[1] not in (h, _near(h))} == {(3, _near(a)), (None, b), (3, c), (7, d), (7, e), (0, f), (0, _near(g))}
    assert sum(out.values()) == 8


WORDS = ["the", "and", "thing", "other", "house", "river", "stone", "light", "water", "under"]


def _english(rng, n):
    return "".join(rng.choice(WORDS) + rng.choice([" ", "  ", "\n", "\t "]) for _ in range(n))


def test_names_that_clash_and_repeated_rows(spark):
    rng = random.Random(8)
    texts = [_english(rng, 60) for _ in range(3)]
    names = [
        "size", "laps", "from_a", "to_b", "accepted", "score", "lang_pred", "row", "taken_text", "__id", "id", "none", "sha", "c1",
        "text_sha256", "component_id"
    ]
    rows = [(i, t, "en", "s", len(t), *[f"v{k}" for k in range(len(names))]) for i, t in enumerate(texts)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema).repartition(2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, docs, ""), "test")
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert all(r["laps"] == "v1" and r["c1"] == "v13" for r in out.collect())
        if name in ("exact_dedup", "jaccard_join"):
            assert sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2]
    mix = corpus_pipeline.mixed(spark, docs, "").collect()
    taken, size = sum(len(r["text"].split()) for r in mix), sum(len(r[1].split()) for r in rows)
    assert abs(taken - 1.5 * size) <= 32 and all(r["n_chars"] == len(r["text"]) for r in mix)
    assert corpus_pipeline.packed(spark, docs, "").count() == 6


def test_cut_texts_are_runs_of_the_original(spark):
    rng = random.Random(4)
    texts = {i: "  " + _english(rng, rng.randrange(3, 90)) for i in range(40)}
    docs = _frame(spark, [*texts.items(), (90, None), (91, ""), (92, " \n")])
    whole = 0
    for r in corpus_pipeline.mixed(spark, docs, "").collect():
        text = texts[r["doc_id"]]
        if r["text"] == text:
            whole += 1
            continue
        ends = [k for k in range(1, len(r["text"])) if r["text"][:k] in text and r["text"][k:].strip() in text]
        assert r["text"] in text or ends, (r["text"], text)
    assert whole > 20


def test_stages_of_an_empty_table_and_of_odd_rows(spark):
    rng = random.Random(3)
    odd = [
        (None, None), (None, ""), (1, " \t"), (2, "123 !"), (3, _english(rng, 30_000)), (3, _english(rng, 20)), (None, _english(rng, 30))
    ]
    clean = [(10 + i, _english(rng, 50)) for i in range(30)]
    for rows in ([], odd + clean):
        docs = spark.createDataFrame(
            [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
        )
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, ""), "test")
        assert docs.count() >= len(rows and clean)


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Each stage on what its predecessor left, computed again without Spark where the operator's law says what must come out."""
    import zlib
    from array import array

    import public_tokenizers
    from tokenizers import Tokenizer

    from tidewright.llm import op04_language_id

    rng = random.Random(21)
    texts = [_english(rng, rng.randrange(40, 120)) for _ in range(50)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[i]) for i in range(10)] + [
        (200 + i, _near(texts[i].strip())) for i in range(10, 20)
    ]
    rows += [(300, "123"), (301, "qxzj kqqz wxqj zzxq " * 10), (None, texts[30]), (None, _english(rng, 60))]
    docs = spark.createDataFrame(
        [(i, t, "en" if i is None or i < 300 else None, f"s{(i or 0) % 3}", len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long"
    ).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs, out = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), "test")
        out.append((before.collect(), docs.collect()))

    was, now = out[0]
    model = op04_language_id.train(
        docs if not was else spark.createDataFrame(was, "doc_id long, text string, lang string, source string, n_chars long")
    )
    ce, n = model.cross_entropy([r["text"] for r in was])
    best = ce.argmin(axis=1)
    assert Counter((r["doc_id"], r["text"]) for r in now) == Counter(
        (r["doc_id"], r["text"]) for r, k, b, c in zip(was, n, best, ce) if k and c[b] <= model.limit[b]
    )

    was, now = out[1]
    keep = {}
    for r in was:
        keep[r["text"]] = max(keep.get(r["text"], -1), -1 if r["doc_id"] is None else r["doc_id"])
    assert Counter((r["text"], -1 if r["doc_id"] is None else r["doc_id"]) for r in now) == Counter(keep.items())

    was, now = out[2]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (r["text"].lower().split() for r in was)]
    group = list(range(len(was)))
    for a in range(len(was)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    first = {}
    for g, r in zip(group, was):
        own = (r["doc_id"] is None, r["doc_id"] or 0)
        first[g] = min(first.get(g, own), own)
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in now) == Counter(first.values())

    was, now = out[3]
    words = lambda rows: Counter({s: sum(len(r["text"].split()) for r in rows if r["source"] == s) for s in {r["source"] for r in rows}})
    have, got = words(was), words(now)
    from tidewright.llm import op07_mixing

    want = dict(zip(sorted(have), op07_mixing.targets([have[s] for s in sorted(have)])))
    assert all(abs(got[s] - want[s]) <= 16 for s in want)
    each = Counter()
    for r in now:
        each[r["doc_id"]] += len(r["text"].split())
    assert all(each[r["doc_id"]] <= 2 * len(r["text"].split()) + (r["doc_id"] is None) * 10**6 for r in was)

    was, now = out[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in was:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[r["doc_id"], at, len(part), zlib.crc32(array("I", part).tobytes())] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in now) == want
