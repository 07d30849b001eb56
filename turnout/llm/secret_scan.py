"""Secret scan: three patterns, and Shannon entropy in windows that slide over candidate strings.

Candidates are the runs of each character class. A window of fixed length slides over a candidate;
the count of the character that comes in goes up and that of the one that leaves goes down, and
with them the sum of ``n log n`` over the counts, so the window's entropy is known at each step
without counting anew. Windows with enough entropy for their class join into spans. Candidates
that an allow-list matches are left alone. Sums are whole numbers, so results are exact.

Everything is DataFrame functions over one row at a time: no shuffle, no Python in tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The keywords before a value, the patterns and their least lengths.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
VALUE = "[A-Za-z0-9+/_.=-]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16


def either_case(text: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in text)


_QUOTE = "[\"']?"
ASSIGN = f"({'|'.join(map(either_case, KEYWORDS))}){_QUOTE}\\x20*[:=]\\x20*{_QUOTE}({VALUE})"
#: A run that is too short has no longer one inside, so the least lengths can be part of these.
ACCESS = f"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}"
HEX = f"[0-9a-f]{{{LEAST_HEX},}}"
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """A class of characters, the length of its windows and the least entropy of each in bits."""

    kind: str
    characters: str
    window: int
    least_bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.characters}]{{{self.window},}}"

    @property
    def most(self) -> int:
        """The largest sum of ``n log n``, as in ``LOGS``, that leaves enough entropy."""
        return floor(UNIT * self.window * (log2(self.window) - self.least_bits))


UNIT, LONGEST_WINDOW = 1_000_000, 64
#: n log2 n, in millionths, of counts from 0.
LOGS = [round(UNIT * n * log2(n)) if n else 0 for n in range(LONGEST_WINDOW + 2)]

CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", 20, 2.8),
    CharacterClass("entropy_upper", "A-Z0-9", 20, 3.2),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 4.0),
)
#: Candidates that are no secrets: words and paths of words, numbers, identifiers of the 8-4-4-4-12
#: form, what says of itself that it is an example, and runs of the alphabet. No groups repeat, so
#: that very long candidates need no deep stack.
ALLOWED = (
    "^[A-Z]?[a-z+/_=-]*$",
    "^[0-9]+$",
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{8}",
    "01234567|abcdefgh|ABCDEFGH",
)

#: Counts are a text with one sign per printable ASCII character, "0" for none.
_FIRST, _ZERO, _NONE = 31, 48, "0" * 96


def _found(text: Column, pattern: str, value_group: int | None = None) -> Column:
    """Matches of a pattern: where each begins and what it is, and the length of a group in it."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if value_group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    between = F.split(text, pattern, -1)
    spans = F.aggregate(
        F.arrays_zip(between.alias("gap"), whole.alias("match"), value.alias("value")),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + F.char_length(x["gap"]) + F.coalesce(F.char_length(x["match"]), F.lit(0))).alias("at"),
            F.when(x["match"].isNull(), s["spans"]).otherwise(F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.char_length(x["gap"])).alias("start"), x["match"].alias("text"),
                F.char_length(x["value"]).alias("size"),
            )))).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    # Most texts have no match and need no places.
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<start:int,text:string,size:int>>"
_PLACES = "array<struct<start:int,stop:int>>"


def _count(counts: Column, c: Column) -> Column:
    return F.ascii(F.substring(counts, F.ascii(c) - _FIRST, F.lit(1))) - _ZERO


def _changed(counts: Column, c: Column, by: int) -> Column:
    return F.overlay(counts, F.chr(_count(counts, c) + (_ZERO + by)), F.ascii(c) - _FIRST, F.lit(1))


def _dense(candidate: Column, of: CharacterClass) -> Column:
    """Where in a candidate, from its beginning, windows with enough entropy lie; joined."""
    logs = F.array(*map(F.lit, LOGS))
    log = lambda n: F.element_at(logs, n + 1)

    def step(s: Column, c: Column) -> Column:
        full = F.char_length(s["window"]) == of.window
        gone = F.substring(s["window"], 1, 1)
        n, entered = _count(s["counts"], c), _changed(s["counts"], c, 1)
        m = _count(entered, gone)
        total = s["total"] + log(n + 1) - log(n) + F.when(full, log(m - 1) - log(m)).otherwise(0)
        return F.struct(
            F.when(full, _changed(entered, gone, -1)).otherwise(entered).alias("counts"),
            total.alias("total"),
            F.concat(F.when(full, F.substring(s["window"], 2, of.window)).otherwise(s["window"]), c).alias("window"),
            (s["at"] + 1).alias("at"),
            s["open"].alias("open"), s["stop"].alias("stop"), s["found"].alias("found"),
        )

    def joined(s: Column) -> Column:
        """With the window that ends at ``at`` taken in, if it has enough entropy."""
        dense = (s["at"] >= of.window) & (s["total"] <= of.most)
        start, apart = s["at"] - of.window, s["at"] - of.window > s["stop"]
        closed = F.when(dense & apart & (s["stop"] > 0), F.concat(s["found"], F.array(F.struct(s["open"].alias("start"), s["stop"].alias("stop")))))
        return F.struct(
            s["counts"].alias("counts"), s["total"].alias("total"), s["window"].alias("window"), s["at"].alias("at"),
            F.when(dense & (apart | (s["stop"] == 0)), start).otherwise(s["open"]).alias("open"),
            F.when(dense, s["at"]).otherwise(s["stop"]).alias("stop"),
            closed.otherwise(s["found"]).alias("found"),
        )

    nothing = F.struct(
        F.lit(_NONE).alias("counts"), F.lit(0).alias("total"), F.lit("").alias("window"), F.lit(0).alias("at"),
        F.lit(0).alias("open"), F.lit(0).alias("stop"), F.array().cast(_PLACES).alias("found"),
    )
    return F.aggregate(
        F.split(candidate, ""), nothing,
        lambda s, c: F.element_at(F.transform(F.array(step(s, c)), joined), 1),
        lambda s: F.when(s["stop"] > 0, F.concat(s["found"], F.array(F.struct(s["open"].alias("start"), s["stop"].alias("stop"))))).otherwise(s["found"]),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: Sequence[CharacterClass] = CLASSES,
         allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``id, found`` of every row: spans ``(start, number, kind, stop, text)`` in their order.

    Places count code points, ``stop`` is past the end. Kinds are ``BASE_KINDS`` and those of
    ``classes``; ``number`` is a kind's place among them, and spans that begin together come in that
    order. ``allowed`` are patterns for candidates of the classes that are no secrets; they do not
    touch the base kinds. Null and empty texts have no spans; whole texts are scanned, however long.
    Null ids and repeated rows are kept, each with its result. Other columns are not read.
    """
    kinds = [*BASE_KINDS, *(of.kind for of in classes)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    text, allow = F.col("text"), "|".join(f"(?:{pattern})" for pattern in allowed)
    found = {
        "assign": F.filter(_found(text, ASSIGN, 2), lambda x: x["size"] >= LEAST_VALUE),
        "access": _found(text, ACCESS),
        "hex": _found(text, HEX),
    }
    for of in classes:
        candidates = _found(text, of.pattern)
        found[of.kind] = F.filter(candidates, lambda x: ~x["text"].rlike(allow)) if allow else candidates
    rows = rows.select("id", *[spans.alias(kind) for kind, spans in found.items()])

    def placed(number: int, kind: str, start: Column, stop: Column, text: Column) -> Column:
        return F.struct(
            start.alias("start"), F.lit(number).alias("number"), F.lit(kind).alias("kind"), stop.alias("stop"), text.alias("text")
        )

    def of_kind(number: int, kind: str, of: CharacterClass | None) -> Column:
        if of is None:
            return F.transform(kind, lambda x: placed(number, kind, x["start"], x["start"] + F.char_length(x["text"]), x["text"]))
        return F.flatten(F.transform(kind, lambda x: F.transform(_dense(x["text"], of), lambda w: placed(
            number, kind, x["start"] + w["start"], x["start"] + w["stop"], F.substring(x["text"], w["start"] + 1, w["stop"] - w["start"])
        ))))

    spans = [of_kind(n, kind, dict(zip(kinds[len(BASE_KINDS):], classes)).get(kind)) for n, kind in enumerate(kinds)]
    return rows.select("id", F.sort_array(F.concat(*spans)).alias("found"))


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:stop``, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
