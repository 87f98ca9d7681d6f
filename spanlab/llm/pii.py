"""Personal data by weak supervision, in DataFrame functions only.

1. *Candidates.*  Strict patterns (email, ip, card, phone) and a wide pattern (obfuscated addresses, local phone
   numbers, social security and bank account numbers, credentials, titled names) give spans with the characters around
   them.  A span's place is the length of the pieces that ``split`` leaves in front of it and of the matches before it.
2. *Labelers.*  A regex labeler, a gazetteer labeler (top-level domains, calling codes, card issuers, given names), a
   context labeler (cue and counter-cue words in front) and a shape labeler vote +1, 0 or -1 on every candidate.
3. *Expectation-maximisation.*  Candidates are counted by kind and votes (at most 8 x 81 rows whatever the input); each
   round estimates every labeler's reliability and every kind's share from the votes' posterior.
4. *Classifier.*  A logistic regression over kind and surface features is fitted to the posteriors (weighted counts
   by feature values) and decides on each candidate.  Spans of the strict patterns that pass their checks always stay;
   the method adds others that touch none of them.

Defined results: null and empty text have no spans; ids, also null or repeated ones, are passed through row by row;
without candidates there is no model and nothing is added; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# The strict patterns.  Look-behind, \G and possessive loops leave the matches of
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+      ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card [0-9]([\x20-]?[0-9])+                                   phone \+[0-9][\x20().0-9-]+[0-9]
# as they are and keep long runs linear and off the Java stack.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no valid match: spares most texts the exact search.
NEEDS = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9][\x20().0-9-]",
}
WIDE = {
    "email": r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]{1,63}){1,4}",
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme)\.? [A-Z][a-z]{1,20} [A-Z][a-z]{1,20}(?![A-Za-z])",
    "secret": r"""(?i)(?:password|passwd|secret|token|api[_-]?key)["']? ?[=:] ?["']?[A-Za-z0-9+/_.-]{8,128}""",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = ["email", "ip", "card", "phone", "iban", "name", "secret", "ssn"]
LABELERS = ["regex", "gazetteer", "context", "shape"]
ROUNDS = 12
BEFORE = 32

# Gazetteers.
TLDS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at", "us", "ca"]
CALLING_CODES = ["1", "31", "32", "33", "34", "39", "41", "43", "44", "46", "49", "52", "54", "55", "61", "81", "86", "91"]
IBAN_COUNTRIES = ["DE", "FR", "ES", "GB", "IT", "NL", "BE", "AT", "CH", "PT", "IE", "LU"]
GIVEN_NAMES = ["James", "Mary", "John", "Anna", "Peter", "Maria", "Hans", "Pierre", "Marie", "Juan", "Carmen", "Thomas", "Laura", "Paul"]
# Words in front of a span for and against it.
CUES = {"email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|payment", "phone": "phone|tel|call|fax|mobile",
        "iban": "iban|account|bank", "name": "name|contact|signed", "secret": "login|key|auth|secret", "ssn": "ssn|social|security"}
COUNTER_CUES = "version|isbn|order|ref|page|chapter|serial|build"


def _matches(text: Column, pattern: str, needs: str, kind: Column | str, check=None) -> Column:
    """array<struct<kind, start, stop, base, m, before, after>> of the leftmost non-overlapping matches."""
    none = F.array().cast("array<struct<kind:string,start:int,stop:int,base:boolean,m:string,before:string,after:string>>")
    m, s = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<m:string,start:int,stop:int>>").alias("got"))

    def step(acc, x):
        at = acc["at"] + F.length(x["s"])
        end = at + F.length(x["m"])
        return F.struct(end.alias("at"), F.array_append(acc["got"], F.struct(x["m"].alias("m"), at.alias("start"), end.alias("stop"))).alias("got"))

    pairs = F.zip_with(m, F.slice(s, 1, F.greatest(F.lit(1), F.size(m))), lambda a, b: F.struct(a.alias("m"), F.coalesce(b, F.lit("")).alias("s")))
    placed = F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), start, step, lambda acc: acc["got"])

    def span(x):
        lo = F.greatest(F.lit(0), x["start"] - BEFORE)
        k = F.lit(kind) if isinstance(kind, str) else reduce(lambda rest, w: F.when(F.regexp_like(x["m"], F.lit(f"^(?:{WIDE[w]})$")), w).otherwise(rest), reversed(list(WIDE)), F.lit("phone"))
        return F.struct(k.alias("kind"), x["start"].cast("int").alias("start"), x["stop"].cast("int").alias("stop"),
                        (check(x["m"]) if check else F.lit(False)).alias("base"), x["m"].alias("m"),
                        F.substring(text, lo + 1, x["start"] - lo).alias("before"), F.substring(text, x["stop"] + 1, F.lit(1)).alias("after"))

    return F.when(F.regexp_like(text, F.lit(needs)), F.transform(placed, span)).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.transform(F.split(F.reverse(_digits(m)), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    total = F.aggregate(F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)), F.lit(0), lambda a, x: a + x)
    return F.length(_digits(m)).between(12, 19) & (total % 10 == 0)


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): all candidates of every text; strict matches that fail their check are kept as candidates
    with ``base`` false."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    strict = [_matches(text, STRICT[k], NEEDS[k], k, CHECKS[k]) for k in STRICT]
    wide = "|".join(f"(?:{p})" for p in WIDE.values())
    return docs.select(F.col(id_col).alias("doc_id"), F.concat(*strict, _matches(text, wide, wide, F.lit(None))).alias("spans"))


def votes(c: Column) -> dict[str, Column]:
    """Votes of the labelers on a candidate."""
    kind, m = c["kind"], c["m"]
    before = F.lower(c["before"])
    digits = _digits(m)

    def of(table: dict[str, Column], default=0) -> Column:
        return reduce(lambda rest, k: F.when(kind == k, table[k]).otherwise(rest), table, F.lit(default)).cast("int")

    def yes(cond: Column, no: int = -1) -> Column:
        return F.when(cond, 1).otherwise(no)

    prefix = reduce(lambda a, b: a | b, (digits.startswith(p) for p in CALLING_CODES))
    cue = reduce(lambda rest, k: F.when(kind == k, F.regexp_like(before, F.lit(rf"\b(?:{CUES[k]})"))).otherwise(rest), CUES, F.lit(False))
    return {
        "regex": F.when(c["base"], 1).when(kind.isin("ip", "card", "phone"), F.when(m.startswith("+"), 0).otherwise(-1)).otherwise(0).cast("int"),
        "gazetteer": of({
            "email": yes(F.lower(F.regexp_extract(m, "([A-Za-z]+)$", 1)).isin(TLDS)),
            "ip": yes(~F.regexp_like(m, F.lit(r"^(?:0|127|255)\."))),
            "card": yes(F.regexp_like(digits, F.lit("^[3-6]"))),
            "phone": F.when(m.startswith("+"), yes(prefix)).otherwise(yes(~F.regexp_like(digits, F.lit("^[01]")))),
            "iban": yes(F.substring(m, 1, 2).isin(IBAN_COUNTRIES)),
            "name": yes(F.regexp_extract(m, r"^\S+ (\S+)", 1).isin(GIVEN_NAMES), 0),
            "ssn": yes(~F.regexp_like(m, F.lit("^(?:000|666|9)|-00-|-0000$"))),
            "secret": yes(F.regexp_like(m, F.lit("[0-9]")) & F.regexp_like(m, F.lit("[=:].*[A-Za-z]"))),
        }),
        "context": F.when(cue, 1).when(F.regexp_like(before, F.lit(rf"\b(?:{COUNTER_CUES})\W*$")), -1).otherwise(0).cast("int"),
        "shape": F.when(F.regexp_like(digits, F.lit(r"^([0-9])\1+$")), -1)
                  .when(kind.isin("card"), yes(F.length(digits).isin(15, 16)))
                  .when(kind.isin("phone"), yes(F.length(digits).between(10, 13)))
                  .when(kind.isin("ip"), yes(F.forall(F.split(m, r"\."), lambda p: F.length(p) <= 3)))
                  .otherwise(yes(F.length(m).between(6, 80))).cast("int"),
    }


def features(c: Column) -> dict[str, Column]:
    """Surface features of a candidate, none of them a vote."""
    n = F.length(c["m"])
    out = {f"is_{k}": (c["kind"] == k).cast("double") for k in KINDS}
    out["checked"] = c["base"].cast("double")
    out["long"] = (n >= 16).cast("double")
    out["short"] = (n < 10).cast("double")
    out["digit_share"] = F.round(F.length(_digits(c["m"])) / F.greatest(n, F.lit(1)), 1)
    out["space_before"] = F.regexp_like(c["before"], F.lit(r"(?:^|[\s:=(\"'])$")).cast("double")
    out["word_after"] = F.regexp_like(c["after"], F.lit("[A-Za-z0-9]")).cast("double")
    out["colon_before"] = F.regexp_like(c["before"], F.lit(r"[:=]\s?$")).cast("double")
    return out


def label_model(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[Column, dict]:
    """Posterior of a candidate as an expression over kind and votes, and the estimated reliabilities.  ``patterns``
    has (kind, one column per labeler, n)."""
    n, y1, seen = F.col("n"), F.col("p"), [-1, 1]  # a 0 is an abstention and no evidence
    p = F.lit(1) / (1 + F.exp(-2.0 * reduce(lambda a, b: a + b, (F.col(x) for x in LABELERS))))
    model: dict = {}
    for _ in range(rounds):
        weights = ((1, n * y1), (0, n * (1 - y1)))
        sums = {("kind", k, y): F.sum(F.when(F.col("kind") == k, w).otherwise(0.0)) for k in KINDS for y, w in weights}
        sums |= {(x, v, y): F.sum(F.when(F.col(x) == v, w).otherwise(0.0)) for x in LABELERS for v in seen for y, w in weights}
        row = patterns.withColumn("p", p).agg(*[s.alias(f"c{i}") for i, s in enumerate(sums.values())]).first()
        got = {k: float(row[i] or 0.0) for i, k in enumerate(sums)}
        model = {"kind": {k: (got["kind", k, 1] + 1) / (got["kind", k, 1] + got["kind", k, 0] + 2) for k in KINDS}}
        for x in LABELERS:
            model[x] = {y: {v: (got[x, v, y] + 1) / (sum(got[x, u, y] for u in seen) + 2) for v in seen} for y in (0, 1)}
        p = posterior(model)
    return p, model


def posterior(model: dict) -> Column:
    from math import log
    s = reduce(lambda rest, k: F.when(F.col("kind") == k, F.lit(log(model["kind"][k] / (1 - model["kind"][k])))).otherwise(rest), KINDS, F.lit(0.0))
    for x in LABELERS:
        for v in (-1, 1):
            s = s + F.when(F.col(x) == v, F.lit(log(model[x][1][v] / model[x][0][v]))).otherwise(0.0)
    return F.lit(1) / (1 + F.exp(-s))


def span_classifier(found: DataFrame) -> dict[str, float] | None:
    """Weights of the final classifier by feature (and "bias"), trained on all candidates of ``found``."""
    c = F.col("c")
    each = stored(found.select(F.explode("spans").alias("c")).select(c["kind"].alias("kind"), *[v.alias(k) for k, v in votes(c).items()],
                                                                     *[v.alias(k) for k, v in features(c).items()])
                  .groupBy("kind", *LABELERS, *features(c)).agg(F.count(F.lit(1)).alias("n")))
    names = list(features(c))
    patterns = stored(each.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")))
    if not patterns.take(1):
        return None
    p, _ = label_model(patterns)
    soft = each.withColumn("p", p).groupBy(*names).agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
    rows = soft.select(*names, F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("yes").alias("w")), F.struct(F.lit(0.0).alias("label"), F.col("no").alias("w")))).alias("x"))
    rows = stored(rows.select(*names, "x.label", "x.w").filter("w > 0"))
    data = VectorAssembler(inputCols=names, outputCol="f").transform(rows)
    fit = LogisticRegression(featuresCol="f", labelCol="label", weightCol="w", regParam=1e-3, maxIter=50).fit(data)
    return dict(zip(names, map(float, fit.coefficients))) | {"bias": float(fit.intercept)}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): array<struct<start, stop, kind, base>> of every row, by start, then kind as listed."""
    found = stored(candidates(docs, id_col, text_col))
    w = span_classifier(found)
    rank = F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (name, k)])

    def believed(c: Column) -> Column:
        if w is None:
            return F.lit(False)
        return reduce(lambda a, b: a + b, (F.lit(w[k]) * v for k, v in features(c).items()), F.lit(w["bias"])) >= 0

    base = F.filter("spans", lambda c: c["base"])
    added = F.filter("spans", lambda c: ~c["base"] & believed(c) & ~F.exists(F.col("base"), lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    shown = F.array_sort(F.transform(F.concat("base", "added"), lambda c: F.struct(c["start"].alias("start"), rank[c["kind"]].alias("order"), c["stop"].alias("stop"), c["kind"].alias("kind"), c["base"].alias("base"))))
    out = found.withColumn("base", base).withColumn("added", added)
    return out.select("doc_id", F.array_distinct(shown).alias("spans"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every found span replaced by its kind in brackets; spans inside another are covered by
    it.  Ids must be unique and not null."""
    spans = find(docs, id_col, text_col)
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(spans, "doc_id")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))))
    return text.select("doc_id", done.alias("text"))


def digest(found: DataFrame) -> DataFrame:
    def listed(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(F.col("base"), lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in STRICT]
    return found.withColumn("base", base).select("doc_id", *counts, F.size("spans").cast("long").alias("n_spans"), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def query(spark, sf_dir):
    from .common import documents
    return digest(find(documents(spark, sf_dir)))
