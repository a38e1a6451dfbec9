"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only. Each kind has a pattern, a check and a prior score. Between matches a text is cut by
the same pattern, so the lengths of the pieces give each match's place in code points. The kinds email, ip,
card and phone are the base: a match that passes its check stays whatever its score. ``iban`` (mod 97) and ``secret`` (a
long hexadecimal token) are added by this method: their score rises with context words just before the span and must reach a limit.

Results for odd inputs: a null or empty text has no spans; repeated rows get equal spans; very long texts and
long runs of digits are read in time proportional to their length (possessive groups, no retries within a run);
an empty table gives no rows; input columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 24
SPAN = "struct<kind:string,first:int,last:int,score:double>"


@dataclass(frozen=True)
class Kind:
    """``needs`` must occur in a text for the pattern to match at all; ``context`` words before a span raise its score."""

    name: str
    needs: str
    pattern: str
    score: float
    context: str
    base: bool = True


# The base patterns, here with possessive groups and starts at the beginning of a run (or right after the
# match before), which find the same spans without trying each run again from every character.
KINDS = (
    Kind(
        "email", "@",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9, r"mail|contact|write",
    ),
    Kind("ip", ".", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", 0.6, r"\bip\b|address|host|server"),
    Kind("card", "", r"[0-9](?:[\x20-]?[0-9])++", 0.7, r"card|visa|master|credit|pay"),
    Kind("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, r"phone|tel|call|mobile|fax"),
    Kind(
        "iban", "", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        0.6, r"iban|account|bank|konto|cuenta|compte", base=False,
    ),
    Kind(
        "secret", "", r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])",
        0.4, r"token|secret|key|passw|api", base=False,
    ),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digits of the doubles added, a sum divisible by ten."""
    reverse = F.split(F.reverse(digits), "")
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    total = F.aggregate(
        F.transform(
            F.filter(reverse, lambda d: d != ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.get(doubled, d.cast("int"))
            ),
        ),
        F.lit(0), lambda a, b: a + b,
    )
    return total % 10 == 0


def _mod97(value: Column) -> Column:
    """The first four characters moved to the end, letters as numbers from ten: the remainder by 97 is one."""
    compact = F.regexp_replace(value, r"\x20", "")
    moved = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    rest = F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda r, c: F.when(c == "", r).when(c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97)
        .otherwise((r * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _passes(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "card":
        return n.between(13, 19) & F.when(n.between(13, 19), _luhn(_digits(value)))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "iban":
        return _mod97(value)
    return F.lit(True)


def _matches(kind: Kind, text: Column) -> Column:
    """Matches with their places; the pieces between them are as long as the text says."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.transform(F.split(text, kind.pattern, -1), F.length)
    # Walk along: before match i lie i + 1 pieces and i matches.
    return F.aggregate(
        F.arrays_zip(found.alias("value"), pieces.alias("gap")),
        F.struct(
            F.lit(0).alias("at"),
            F.expr("cast(array() as array<struct<value:string,first:int>>)").alias("out"),
        ),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + F.coalesce(F.length(m["value"]), F.lit(0))).alias("at"),
            F.when(m["value"].isNull(), s["out"]).otherwise(
                F.array_append(
                    s["out"],
                    F.struct(m["value"].alias("value"), (s["at"] + m["gap"]).alias("first")),
                )
            ).alias("out"),
        ),
        lambda s: s["out"],
    )


def _spans(kind: Kind, text: Column, min_score: float) -> Column:
    """Confirmed spans of one kind with their scores, in order."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    confirmed = F.filter(_matches(kind, text), lambda m: _passes(kind.name, m["value"]))
    scored = F.transform(
        confirmed,
        lambda m: F.struct(
            F.lit(kind.name).alias("kind"), m["first"].alias("first"),
            (m["first"] + F.length(m["value"])).alias("last"),
            F.when(
                F.lower(
                    F.substring(
                        text, F.greatest(m["first"] - CONTEXT_CHARS + 1, F.lit(1)),
                        F.least(m["first"], F.lit(CONTEXT_CHARS)),
                    )
                ).rlike(kind.context),
                F.lit((kind.score + 1) / 2),
            ).otherwise(F.lit(kind.score)).alias("score"),
        ),
    )
    if not kind.base:
        scored = F.filter(scored, lambda s: s["score"] >= min_score)
    return F.when(_worth(kind, text), scored).otherwise(none)


def _worth(kind: Kind, text: Column) -> Column:
    """A cheap test that every text with a match passes."""
    if kind.needs:
        return text.contains(kind.needs)
    return text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}" if kind.name == "card" else kind.pattern)


def find_pii(df: DataFrame, text: str = "text", *, min_score: float = 0.5, into: str = "pii") -> DataFrame:
    """All columns of ``df`` and its spans: arrays of (kind, first, last, score) by kind as listed, then place."""
    body = F.coalesce(F.col(text), F.lit(""))
    return df.drop(into).withColumn(into, F.concat(*[_spans(k, body, min_score) for k in KINDS]))


def written(spans: Column) -> Column:
    """kind:first:last of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ","
    )


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: reduce(lambda a, b: a | b, [s["kind"] == k for k in kinds]))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one.

    Pieces are gathered in order of place; of overlapping spans the first names the whole.
    """
    ordered = F.sort_array(
        F.transform(
            spans,
            lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), s["kind"].alias("kind")),
        )
    )
    walked = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda s, p: F.struct(
            F.greatest(s["at"], p["last"]).alias("at"),
            F.when(p["first"] < s["at"], s["out"]).otherwise(
                F.concat(
                    s["out"],
                    F.array(
                        F.substring(text, s["at"] + 1, p["first"] - s["at"]),
                        F.concat(F.lit("<"), F.upper(p["kind"]), F.lit(">")),
                    ),
                )
            ).alias("out"),
        ),
        lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, walked).otherwise(text)
