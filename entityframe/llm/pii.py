"""Personal data in text, with DataFrame functions only.

Regular expressions propose spans, checksums confirm them, and words nearby
raise or lower the score that the form alone gives: a span of a kind that is not
a base one counts only if its score reaches ``THRESHOLD``.

Positions come from ``split`` and ``regexp_extract_all`` on one pattern: a
match starts after all earlier matches and gaps. Patterns use possessive
quantifiers and start only where a run of their first class starts (or right
after the match before), which finds the same matches as the plain form in
linear time and without deep recursion on long runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityframe.llm.line_dedup import ascii_lower

CONTEXT_CHARS = 40
THRESHOLD = 50  # scores are hundredths
FOR, AGAINST = 50, 30


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _octets_fit(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def luhn(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def mod97(match: Column) -> Column:
    """The check of an IBAN: letters become 10..35, the first four move to the end, remainder 1."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda acc, c: (
            acc * F.when(c < "A", 10).otherwise(100) + F.conv(c, 36, 10).cast("int")
        ) % 97,
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _yes(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap test that must hold for the pattern to match anywhere.

    ``score`` is that of the form alone, in hundredths; words of ``context`` nearby speak for it, those of
    ``against`` against it.
    """

    name: str
    pattern: str
    hint: str
    valid: object = _yes
    base: bool = False
    score: int = 90
    context: str = ""
    against: str = ""


# The forms of each kind, in the order in which equal starts are listed.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        base=True,
        context=r"mail|contact|write to",
        against=r"no-?reply|example\.",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        _octets_fit,
        base=True,
        score=50,
        context=r"\bips?\b|address|host|server|login",
        against=r"version|release|section|chapter",
    ),
    Kind(
        "card",
        r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++",
        r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
        luhn,
        base=True,
        score=70,
        context=r"card|visa|master|credit|payment",
        against=r"order|tracking|serial|isbn",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]",
        lambda m: F.length(_digits(m)).between(10, 15),
        base=True,
        score=60,
        context=r"phone|mobile|call|fax|tel\b",
        against=r"order|serial|isbn",
    ),
    Kind(
        "iban",
        r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
        r"[A-Z]{2}[0-9]{2}",
        mod97,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"[0-9]-[0-9]{2}-[0-9]",
        lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"),
        score=30,
        context=r"ssn|social security|taxpayer",
        against=r"order|serial|\bpart\b",
    ),
    Kind(
        "national_phone",
        r"(?<![0-9+().-])(?:\([0-9]{2,5}\)\x20?|0)[0-9]{2,4}(?:[\x20.-][0-9]{2,5}){1,3}(?![0-9-])",
        r"[0-9][)\x20.-]",
        lambda m: F.length(_digits(m)).between(9, 12),
        score=20,
        context=r"phone|telephone|mobile|call|fax|tel\b",
        against=r"section|chapter|version|order|isbn",
    ),
    Kind("aws_key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", "A[KS]IA"),
    Kind(
        "api_token",
        r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35})",
        "gh[pousr]_|xox[abprs]-|sk_live_|AIza",
    ),
    Kind("private_key", r"-----BEGIN (?:[A-Z]{2,10} ){0,3}PRIVATE KEY-----", "PRIVATE KEY"),
    Kind("jwt", r"\beyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", r"\.eyJ"),
    Kind(
        "secret",
        r"(?i)\b(?:api[_-]?key|secret|password|passwd|access[_-]?token)[\x22\x27]?\s?[:=]\s?[\x22\x27]?[^\s\x22\x27]{8,}+",
        "(?i)key|secret|passw|token",
        score=60,
        against=r"example|placeholder|changeme|xxxx|your[_-]",
    ),
)
SECRETS = ("aws_key", "api_token", "private_key", "jwt", "secret")


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (start, kind order, end, score) of the kind's accepted spans, in code points."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    after = F.slice(gaps, F.lit(2), F.size(gaps))
    spans = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), found.alias("match"), after.alias("next")),
        F.struct(
            F.lit(0).alias("at"),
            F.lit("").alias("tail"),
            F.array().cast("array<struct<start:int,end:int,match:string,near:string>>").alias("out"),
        ),
        # What lies before a span is carried along, so that no span looks into the whole text again.
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))).alias("at"),
            F.right(F.concat(acc["tail"], x["gap"], F.coalesce(x["match"], F.lit(""))), F.lit(CONTEXT_CHARS)).alias("tail"),
            F.when(x["match"].isNull(), acc["out"])
            .otherwise(
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(x["gap"])).alias("start"),
                            (acc["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"),
                            x["match"].alias("match"),
                            F.concat(
                                F.right(F.concat(acc["tail"], x["gap"]), F.lit(CONTEXT_CHARS)),
                                x["match"],
                                F.left(F.coalesce(x["next"], F.lit("")), F.lit(CONTEXT_CHARS)),
                            ).alias("near"),
                        )
                    ),
                )
            )
            .alias("out"),
        ),
        lambda acc: acc["out"],
    )

    def score(x: Column) -> Column:
        near, total = ascii_lower(x["near"]), F.lit(kind.score)
        if kind.context:
            total = total + F.when(near.rlike(kind.context), FOR).otherwise(0)
        if kind.against:
            total = total - F.when(near.rlike(kind.against), AGAINST).otherwise(0)
        return F.least(F.greatest(total, F.lit(0)), F.lit(100))

    valid = F.filter(spans, lambda x: kind.valid(x["match"]))
    out = F.transform(
        valid,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            x["end"].alias("end"),
            score(x).alias("score"),
        ),
    )
    if not kind.base:
        out = F.filter(out, lambda x: x["score"] >= THRESHOLD)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,score:int>>")
    return F.when(text.rlike(kind.hint), out).otherwise(none)


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``: array of (kind, start, end, score), by start, then in the order of KINDS.

    Starts and ends are code points, end exclusive; null is an empty text. Scores are
    hundredths: that of the form, 50 more where a word that goes with the kind lies within 40 characters,
    30 less where one that goes with something else does. Base
    kinds (email, ip, card, phone) are always kept once valid, whatever their score. Others need a
    score of 50 and must not overlap a base span. Rows are independent of each other: repeated rows get equal
    spans, an empty table gives an empty result, and a column already named
    ``pii_spans`` is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    mine = docs.withColumns({f"_pii_{k.name}": _matches(text, k) for k in KINDS})
    base = F.concat(*(F.col(f"_pii_{k.name}") for k in KINDS if k.base))
    mine = mine.withColumn("_pii_base", base)
    more = F.concat(*(F.col(f"_pii_{k.name}") for k in KINDS if not k.base))

    def free(x: Column) -> Column:
        return ~F.exists(
            F.col("_pii_base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])
        )

    ordered = F.array_sort(F.concat(F.col("_pii_base"), F.filter(more, free)))
    names = F.array(*(F.lit(k.name) for k in KINDS))
    spans = F.transform(
        ordered,
        lambda x: F.struct(
            F.get(names, x["kind"]).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["score"].alias("score"),
        ),
    )
    return mine.withColumn("pii_spans", spans).drop("_pii_base", *(f"_pii_{k.name}" for k in KINDS))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def _of_kind(name: str):
    return lambda x: x["kind"] == name


def op9_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans = F.col("pii_spans")
    base = [k.name for k in KINDS if k.base]
    return find_pii(docs).select(
        "doc_id",
        *(
            F.size(F.filter(spans, _of_kind(name))).cast("bigint").alias(f"n_{name}")
            for name in base
        ),
        F.sha2(_listed(F.filter(spans, lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        F.size(F.filter(spans, lambda x: x["kind"].isin(*SECRETS))).cast("bigint").alias("n_secret"),
        F.array_join(F.transform(spans, lambda x: x["score"].cast("string")), ",").alias("scores"),
    )
