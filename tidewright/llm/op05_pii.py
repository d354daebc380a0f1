r"""Personal data by weak supervision.

Native: DataFrame functions only. Candidate spans come from patterns: the base
ones of the contract and wider ones (obfuscated addresses, defanged or longer
IP addresses, card numbers with other separators, phone numbers without +).
Four labelers (shape, gazetteer, context, checksum) vote for, against or not
at all. Counts of vote patterns over the whole table, a few hundred rows a
kind however large it is, go to the driver. There expectation-maximisation
estimates each labeler's reliability, kind by kind; base spans are known to be
good and base matches that fail their check known to be bad. A logistic
classifier over votes and further features of a span is fitted to the
posteriors. Base spans always stay; a wider candidate stays when the
classifier accepts it, its checksum doesn't fail, and it touches no base span.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, read

KINDS = ("email", "ip", "card", "phone")
LOCAL = r"A-Za-z0-9._%+-"
#: Base patterns, as in the contract; possessive and anchored at the start of a run, which changes no match.
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What every match of a base pattern holds; a text without it needs no search.
BASE_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_AT = r"(?: ?[(\[{]at[)\]}] ?| at )"
_DOT = r"(?: ?[(\[{]dot[)\]}] ?| dot |\.)"
_POINT = r"(?:\[\.\]|\(\.\)|[\[(]dot[\])])"
#: Wider candidates and what each of them holds.
WIDE = {
    "email": rf"(?i)(?<![{LOCAL}@])[A-Z0-9._%+-]{{1,64}}{_AT}[A-Z0-9-]{{1,63}}(?:{_DOT}[A-Z0-9-]{{2,63}}){{1,8}}(?![A-Za-z0-9@])",
    "ip": rf"(?i)(?<![0-9A-F:.])(?:[0-9]{{1,3}}(?:{_POINT}[0-9]{{1,3}}){{3}}|[0-9A-F]{{1,4}}(?::[0-9A-F]{{1,4}}){{7}})(?![0-9A-F:.]?[0-9A-F:])",
    "card": r"(?<![0-9.+/_-])[0-9]{4}(?:[./_]|[ -]{2,3})[0-9]{4}(?:[./_]|[ -]{2,3})[0-9]{4}(?:[./_]|[ -]{2,3})[0-9]{4}(?![0-9./_-]?[0-9])",
    "phone": r"(?<![0-9A-Za-z.+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])|(?<![0-9A-Za-z.+(-])00[1-9][0-9]{0,2}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9-])",
}
WIDE_NEEDS = {
    "email": r"(?i)[(\[{ ]at[)\]} ]",
    "ip": r"(?i)[0-9](?:\[\.\]|\(\.\)|[\[(]dot)|[0-9A-F]:[0-9A-F]{1,4}:",
    "card": r"[0-9]{4}[./_ -]+[0-9]{4}",
    "phone": r"[0-9]{3}\)? ?[ .-]?[0-9]{3}[ .-][0-9]{4}|00[1-9]",
}
#: Fixed values of the gazetteers: endings of addresses, first digits of card issuers, private networks, dial codes.
ENDINGS = (
    "com org net edu gov mil int info biz name pro app dev io ai co me tv cc eu uk de fr es it nl be at ch lu ie pt dk se no fi is pl "
    "cz sk hu ro bg gr "
    "tr ru ua us ca mx br ar cl au nz jp cn kr in sg hk za il ae example test"
).split()
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6(011|5))"
PRIVATE = r"^(10|127|169.254|172.(1[6-9]|2[0-9]|3[01])|192.168)[^0-9]|^f[cd]|^fe80|^2001"
DIAL = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 380 420 421".split()
#: Words before a span that speak for its kind, and words that speak against any.
CUES = {
    "email": r"(?i)(mail|contact|write|reach|from|to|at|adresse|correo|schreib\w*|courriel)\W{0,3}$",
    "ip": r"(?i)(ip|host|server|address|from|at|addr|node|ping|serveur|servidor)\W{0,3}$",
    "card": r"(?i)(card|visa|mastercard|amex|credit|payment|number|karte|carte|tarjeta|paid|pay)\W{0,4}$",
    "phone": r"(?i)(phone|call|tel|mobile|fax|contact|at|cell|telefon|anruf|appelez|llame|ring)\W{0,4}$",
}
AGAINST = r"(?i)(order|invoice|isbn|serial|version|tracking|part|ticket|id|no|ref|build|page|bestellung|commande|pedido)\W{0,4}$"
CONTEXT, LABELERS, FEATURES = 24, 4, 3
#: Expectation-maximisation: rounds; what a labeler's votes are worth before data; steps and penalty of the classifier.
ROUNDS, PRIOR, PRIOR_WEIGHT, STEPS, RIDGE = 40, {1: 0.7, 0: 0.25, -1: 0.05}, 4.0, 400, 0.01
SPAN = "array<struct<start:bigint,k:int,end:bigint,hit:string,before:string,base:boolean>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: what a lambda doesn't depend on is else computed for every element."""
    return F.transform(F.array(value), body)[0]


def scan(values: Column, step: Callable[[Column, Column], Column], zero: int) -> Column:
    """Running step(so far, x) over an array of longs: in blocks of sqrt(n), since appending to an array copies it."""
    longs = F.array().cast("array<bigint>")
    start = F.struct(F.lit(zero).cast("long").alias("at"), longs.alias("out"))

    def along(xs: Column) -> Column:
        def add(acc, x):
            now = step(acc["at"], x)
            return F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out"))

        return F.aggregate(xs, start, add)

    def blocks(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))), F.lit(1)).cast("int")

        def cut(w: Column) -> Column:
            last = F.greatest(F.floor((F.size(v) - 1) / w), F.lit(0)).cast("int")
            return F.transform(F.sequence(F.lit(0), last), lambda i: along(F.slice(v, i * w + 1, w)))

        return _let(width, cut)

    def joined(parts: Column) -> Column:
        before = F.concat(F.array(F.lit(zero).cast("long")), along(F.transform(parts, lambda p: p["at"]))["out"])
        both = F.arrays_zip(parts.alias("p"), F.slice(before, F.lit(1), F.size(parts)).alias("b"))
        return F.flatten(F.transform(both, lambda z: F.transform(z["p"]["out"], lambda x: step(z["b"], x))))

    return _let(values, lambda v: _let(blocks(v), joined))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _spans(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Spans of all matches, in code points: ends are running sums of the lengths of matches and of what lies between."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)

    def place(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda x: (F.length(x["p"]) + F.length(x["h"])).cast("long"))
        ended = F.arrays_zip(pairs.alias("x"), scan(lengths, _plus, 0).alias("end"))

        def span(z):
            x = z["x"]
            return F.struct(
                (z["end"] - F.length(x["h"])).alias("start"), F.lit(KINDS.index(kind)).alias("k"), z["end"].alias("end"),
                x["h"].alias("hit"), F.right(x["p"], F.lit(CONTEXT)).alias("before"), F.lit(base).alias("base"),
            )

        return F.transform(ended, span).cast(SPAN)

    pairs = F.filter(F.arrays_zip(parts.alias("p"), hits.alias("h")), lambda x: x["h"].isNotNull())
    return _let(pairs, lambda p: F.when(F.size(p) > 0, place(p)).otherwise(F.array().cast(SPAN)))


def _apart(base: Column, wide: Column) -> Column:
    """Spans of wide that overlap none of base: by the furthest base end before each and the nearest base start after."""
    far = 1 << 62

    def check(both: Column) -> Column:
        ends = F.transform(both, lambda s: F.when(s["base"], s["end"]).otherwise(F.lit(0)).cast("long"))
        starts = F.transform(F.reverse(both), lambda s: F.when(s["base"], s["start"]).otherwise(F.lit(far)).cast("long"))
        reach = scan(ends, lambda a, x: F.greatest(a, x), 0)
        ahead = F.reverse(scan(starts, lambda a, x: F.least(a, x), far))
        z = F.arrays_zip(both.alias("s"), reach.alias("reach"), ahead.alias("ahead"))
        z = F.filter(z, lambda x: ~x["s"]["base"] & (x["reach"] <= x["s"]["start"]) & (x["ahead"] >= x["s"]["end"]))
        return F.transform(z, lambda x: x["s"])

    some = (F.size(base) > 0) & (F.size(wide) > 0)
    return F.when(some, _let(F.array_sort(F.concat(base, wide)), check)).otherwise(wide)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+", "")
        small = lambda x: F.length(part(x)).between(0, 2) | (part(x).between("0", "255") & (F.length(part(x)) == 3))
        return F.forall(F.split(hit, "[^0-9]+"), small)
    if kind == "card":
        return n.between(12, 19) & F.when(n.between(12, 19), F.call_function("luhn_check", _digits(hit))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def candidates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k, base, bad, wide): base spans are valid, bad ones match a base pattern but fail its check, wide ones touch no base span."""
    t = df.select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    none = F.array().cast(SPAN)
    needs = lambda p: F.col("t").rlike(p)
    found = {f"b_{k}": F.when(needs(BASE_NEEDS[k]), _spans(F.col("t"), k, p, True)).otherwise(none) for k, p in BASE.items()}
    found |= {f"w_{k}": F.when(needs(WIDE_NEEDS[k]), _spans(F.col("t"), k, p, False)).otherwise(none) for k, p in WIDE.items()}
    t = t.select("k", *[c.alias(n) for n, c in found.items()])
    valid = {k: (lambda kind: lambda s: _valid(kind, s["hit"]))(k) for k in BASE}
    fails = {k: (lambda kind: lambda s: ~_valid(kind, s["hit"]))(k) for k in BASE}
    good = F.array_sort(F.concat(*[F.filter(f"b_{k}", valid[k]) for k in BASE]))
    bad = F.concat(*[F.filter(f"b_{k}", fails[k]) for k in BASE if k != "email"])
    t = t.select("k", good.alias("base"), bad.alias("bad"), F.concat(*[F.col(f"w_{k}") for k in WIDE]).alias("wide"))
    return t.select("k", "base", "bad", _apart(F.col("base"), F.col("wide")).alias("wide"))


def _pick(k: Column, by: dict[str, Column], other: Column) -> Column:
    out = other
    for name, x in by.items():
        out = F.when(k == KINDS.index(name), x).otherwise(out)
    return out


def votes(s: Column) -> list[Column]:
    """Shape, gazetteer, context and checksum: 1 for, -1 against, 0 no vote."""
    k, hit, before = s["k"], s["hit"], s["before"]
    digits = _digits(hit)
    n = F.length(digits)
    yes = lambda c, no=-1: F.when(c, 1).otherwise(no)
    plain = F.regexp_replace(F.regexp_replace(hit, f"(?i){_AT}", "@"), f"(?i){_DOT}", ".")
    ending = F.lower(F.regexp_extract(plain, r"\.([A-Za-z0-9-]+)$", 1))
    code = F.regexp_replace(F.regexp_replace(hit, r"^(\+|00)", ""), "[^0-9].*$", "")
    abroad = hit.startswith("+") | hit.startswith("00")
    known = F.lit(False)
    for size in (1, 2, 3):
        known = known | F.substring(
            digits, F.when(hit.startswith("00"), 3).otherwise(1), F.lit(size)
        ).isin(*[d for d in DIAL if len(d) == size])
    parts = lambda p: hit.rlike(p)
    even = r"^[0-9]{4}([^0-9]+)[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{12,19}$|^[0-9]{4}(?:[ -]?[0-9]+)+$"
    shape = _pick(k, {
        "email": yes(plain.rlike(r"^[A-Za-z0-9._%+-]+@([A-Za-z0-9-]+\.)+[A-Za-z]{2,}$")), "ip": F.lit(1),
        "card": yes(parts(even)), "phone": yes(parts(r"^\+|^00|^\(|^[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}$"), 0),
    }, F.lit(0))
    names = _pick(k, {
        "email": yes(ending.isin(*ENDINGS)), "ip": yes(F.lower(hit).rlike(PRIVATE), 0), "card": yes(digits.rlike(ISSUERS)),
        "phone": F.when(abroad, yes(known)).otherwise(yes(code.rlike("^[(]?[2-9]") | digits.rlike("^[2-9]"), -1)),
    }, F.lit(0))
    cue = _pick(k, {name: F.when(before.rlike(AGAINST), -1).otherwise(yes(before.rlike(p), 0)) for name, p in CUES.items()}, F.lit(0))
    check = _pick(k, {
        "email": yes(hit.rlike(r"@|[(\[{]|^[^ ]*[._0-9]"), 0), "ip": yes(hit.contains(":") | _valid("ip", hit)),
        "card": yes(_valid("card", hit)), "phone": yes(n.between(9, 15) & ~digits.rlike(r"^([0-9])\1+$")),
    }, F.lit(0))
    return [shape, names, cue, check]


def features(s: Column) -> list[Column]:
    """What the classifier sees besides votes: a long span, one glued to a word, one with brackets."""
    glued = s["before"].rlike("[A-Za-z0-9]$")
    return [c.cast("int") for c in (F.length(s["hit"]) > 24, glued, s["hit"].rlike(r"[()\[\]{}]"))]


def em(votes_: np.ndarray, n: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Posterior of each vote pattern by Dawid and Skene's model with two classes.

    votes_: patterns x labelers; n: spans of each; known: 1 good, 0 bad, -1
    unknown. A labeler starts as PRIOR says, which counts as PRIOR_WEIGHT spans.
    """
    worth = np.array([[PRIOR[-v] for v in (-1, 0, 1)], [PRIOR[v] for v in (-1, 0, 1)]])
    rate = np.repeat(worth[:, None, :], LABELERS, axis=1)
    share, place = 0.5, votes_ + 1
    post = np.zeros(len(n))
    for _ in range(ROUNDS):
        odds = np.log(share / (1 - share)) + sum(np.log(rate[1, j, place[:, j]] / rate[0, j, place[:, j]]) for j in range(LABELERS))
        post = np.where(known >= 0, known, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
        weight = np.stack([n * (1 - post), n * post])
        free = known < 0  # the share of good ones among candidates isn't that among known ones
        share = (weight[1, free].sum() + PRIOR_WEIGHT / 2) / (weight[:, free].sum() + PRIOR_WEIGHT)
        for c in (0, 1):
            for j in range(LABELERS):
                seen = np.bincount(place[:, j], weight[c], 3) + PRIOR_WEIGHT * worth[c]
                rate[c, j] = seen / seen.sum()
    return post


def fit(table: dict[tuple[int, ...], int]) -> list[list[float]]:
    """Per kind the classifier's weights: bias, for each labeler one for +1 and one for -1, and one for each feature.

    table: (kind, known, votes, features) -> spans.
    """
    out = []
    for kind in range(len(KINDS)):
        rows = sorted((p, c) for p, c in table.items() if p[0] == kind)
        w = np.zeros(1 + 2 * LABELERS + FEATURES)
        if rows:
            p, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
            v, f = p[:, 2 : 2 + LABELERS], p[:, 2 + LABELERS :]
            post = em(v, n, p[:, 1])
            x = np.concatenate([np.ones((len(n), 1)), (v == 1), (v == -1), f], axis=1).astype(float)
            share = np.sqrt(n) / np.sqrt(n).sum()  # the many base spans shall not drown the candidates
            for _ in range(STEPS):
                y = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                w = w - 2.0 * (x.T @ (share * (y - post)) + RIDGE * w / len(n))
        out.append(w.tolist())
    return out


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base and extra: arrays of (start, k, end, hit); k indexes KINDS.

    Null texts count as empty: no span. Repeated rows each get their result,
    and count as often for the labelers; a null id stays null; an empty table
    gives an empty result; other columns are ignored. Work on a text grows
    with its length, and by the power 1.5 with its matches.
    """
    found = materialize(candidates(df, id_col, text_col), "pii")
    tagged = lambda c, known: F.transform(c, lambda s: F.struct(s.alias("s"), F.lit(known).alias("known")))
    each = found.select(F.explode(F.concat(tagged("base", 1), tagged("bad", 0), tagged("wide", -1))).alias("x"))
    marks = [F.col("x.s.k"), F.col("x.known"), *votes(F.col("x.s")), *features(F.col("x.s"))]
    names = [f"m{i}" for i in range(len(marks))]
    counts = each.select(*[c.cast("int").alias(n) for n, c in zip(names, marks)]).groupBy(*names).count().collect()
    weights = fit({tuple(r[:-1]): r[-1] for r in counts})

    def accepted(s: Column) -> Column:
        v, z = votes(s), F.lit(0.0)
        terms = [
            F.lit(1.0), *[(x == 1).cast("double") for x in v], *[(x == -1).cast("double") for x in v],
            *[x.cast("double") for x in features(s)]
        ]
        for i, term in enumerate(terms):
            z = z + term * _pick(s["k"], {name: F.lit(weights[j][i]) for j, name in enumerate(KINDS)}, F.lit(0.0))
        return (z > 0) & (v[3] >= 0)

    slim = lambda a: F.transform(
        a, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), s["hit"].alias("hit"))
    )
    return found.select(F.col("k").alias(id_col), slim(F.col("base")).alias("base"), slim(F.filter("wide", accepted)).alias("extra"))


def render(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def query(spark, sf_dir: str) -> DataFrame:
    t = find_pii(read(spark, sf_dir, "documents"))
    of = lambda i: lambda s: s["k"] == i
    n = [F.size(F.filter("base", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return t.select(
        "doc_id", *n, F.sha2(render(F.col("base")), 256).alias("base_sha256"),
        render(F.array_sort(F.concat("base", "extra"))).alias("spans"),
        F.size(F.concat("base", "extra")).cast("long").alias("n_spans"),
    )
