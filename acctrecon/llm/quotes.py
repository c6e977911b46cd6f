"""Chat formatting by quotation linking.

Messages may quote earlier ones in the manner of mail: leading '>' marks, one
for each level of nesting.  Each message is parsed into its own text and its
quoted passages with their level.  Passages (paragraphs, then their lines, then
sentences, which also link part of a paragraph or one that was wrapped anew)
are normalised and hashed, and joined with the first message of the
conversation that has the passage as text of its own.  A message replies to the latest
original of its outermost quotes that an earlier turn wrote; one that quotes
nothing known replies to the turn before it.  The rebuilt conversation has
each message once, without quotes, after the one that it replies to, and
replies to one message side by side.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import batches, cut, positions, rows_of

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
#: A line that announces a quotation, when one follows.
_SAYS = re.compile(r"[ \t]*(?:On\b.{0,200}\bwrote|.{1,100}\b(?:wrote|said|writes)):[ \t]*$")
#: White space between sentences.
_SENTENCE = re.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*\s+|(?<=[。！？])")
_MESSAGE = "conv_id long, turn long, role string, text string, max_level int"


def levels(text: str) -> list[tuple[int, str]]:
    """(quote level, line without its marks) of each line."""
    out = []
    for line in text.split("\n"):
        m = _MARKS.match(line)
        out.append((m[1].count(">"), line[m.end():]) if m else (0, line))
    return out


def own_text(parsed: list[tuple[int, str]]) -> str:
    """The lines of level 0, without announcements of quotes."""
    keep = []
    for i, (level, line) in enumerate(parsed):
        nxt = next((x for x, s in parsed[i + 1:i + 3] if s.strip()), 0) if line.rstrip().endswith(":") else 0
        if level == 0 and not (nxt and _SAYS.match(line)):
            keep.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(keep)).strip()


def passage_key(text: str) -> int | None:
    """Hash of a passage, of any case, spacing and outer punctuation."""
    words = " ".join(re.findall(r"\w+", text.casefold()))
    return int.from_bytes(hashlib.blake2b(words.encode(), digest_size=8).digest(), "little", signed=True) \
        if words else None


def passages(parsed: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """Distinct (level, grain, key) of a message: grain 0 for a paragraph, a
    run of lines of one level; 1 for each of its lines; 2 for each of its
    sentences, which may run over lines."""
    found: set[tuple[int, int, int]] = set()
    run: list[str] = []
    last = 0

    def close():
        whole = " ".join(run)
        if run and (key := passage_key(whole)) is not None:
            found.add((last, 0, key))
            found.update((last, 2, k) for x in _SENTENCE.split(whole) if (k := passage_key(x)) is not None)
        run.clear()

    for level, line in parsed:
        if level != last or not line.strip():
            close()
        last = level
        if line.strip():
            run.append(line)
            if (key := passage_key(line)) is not None:
                found.add((level, 1, key))
    close()
    return sorted(found)


def _parsed(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All messages' own texts, and their passages."""
    base = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role",
                           F.coalesce("text", F.lit("")).alias("text"))
    m_schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                          ("text", pa.string()), ("max_level", pa.int32())])
    p_schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("level", pa.int32()),
                          ("grain", pa.int32()), ("key", pa.int64())])

    def texts(stream):
        def rows():
            for conv, turn, role, text in rows_of(stream):
                parsed = levels(text)
                yield conv, turn, role, own_text(parsed), max(x for x, _ in parsed)
        yield from batches(rows(), m_schema, lambda r: len(r[3]) + 64)

    def keys(stream):
        def rows():
            for conv, turn, _, text in rows_of(stream):
                parsed = levels(text)
                for p in passages(parsed):
                    yield conv, turn, *p
        yield from batches(rows(), p_schema)

    return (base.mapInArrow(texts, _MESSAGE),
            base.where("conv_id is not null and turn is not null")
            .mapInArrow(keys, "conv_id long, turn long, level int, grain int, key long"))


def quote_links(found: DataFrame) -> DataFrame:
    """(conv_id, turn, level, grain, key, original): quoted passages and the
    first turn that wrote each, null if no earlier one did."""
    first = cut(found.where("level = 0").groupBy("conv_id", "grain", "key").agg(F.min("turn").alias("original"))
                .select(F.col("conv_id").alias("_c"), F.col("grain").alias("_g"), F.col("key").alias("_k"),
                        "original"), "originals")
    quoted = found.where("level > 0").distinct()
    return quoted.join(first, (F.col("conv_id") == F.col("_c")) & (F.col("grain") == F.col("_g"))
                       & (F.col("key") == F.col("_k")) & (F.col("original") < F.col("turn")), "left") \
        .select("conv_id", "turn", "level", "grain", "key", "original")


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text): conv_id,
    turn, role, parent_turn, position (place in the rebuilt conversation),
    n_quotes (quoted paragraphs), n_linked (those whose original was found),
    max_level, text (without quotes).

    Null and empty texts are empty messages.  Rows that repeat a conv_id and
    turn are messages of their own with one common parent; their order among
    each other is by role and text.  Rows with a null conv_id form one
    conversation, null turns come first in theirs; neither quotes nor is
    quoted.  Other columns are not read; an empty table gives an empty result.
    """
    texts, found = _parsed(messages)
    texts, found = cut(texts, "messages"), cut(found, "passages")
    links = cut(quote_links(found), "links")
    # outermost level first, paragraphs before lines before sentences, the
    # latest original
    by = F.struct((-F.col("level")).alias("l"), (-F.col("grain")).alias("g"), F.col("original").alias("o"))
    replies = (links.groupBy("conv_id", "turn")
               .agg(F.max(F.when(F.col("original").isNotNull(), by)).alias("best"),
                    F.sum((F.col("grain") == 0).cast("long")).alias("n_quotes"),
                    F.sum(((F.col("grain") == 0) & F.col("original").isNotNull()).cast("long")).alias("n_linked"))
               .select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("best.o").alias("quoted_turn"),
                       "n_quotes", "n_linked"))
    turns = cut(positions(texts.select("conv_id", "turn").distinct(), "conv_id", ["turn"], "at"), "turns")
    before = turns.select(F.col("conv_id").alias("_pc"), (F.col("at") + 1).alias("_pa"), F.col("turn").alias("prior"))
    turns = (turns.join(before, F.col("conv_id").eqNullSafe(F.col("_pc")) & (F.col("at") == F.col("_pa")), "left")
             .join(replies, (F.col("conv_id") == F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
             .select(F.col("conv_id").alias("_mc"), F.col("turn").alias("_mt"),
                     F.coalesce("quoted_turn", "prior").alias("parent_turn"),
                     F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
                     F.coalesce("n_linked", F.lit(0)).alias("n_linked")))
    whole = (texts.join(cut(turns, "replies"), F.col("conv_id").eqNullSafe(F.col("_mc"))
                        & F.col("turn").eqNullSafe(F.col("_mt")))
             .select("conv_id", "turn", "role", "parent_turn", "n_quotes", "n_linked", "max_level", "text"))
    placed = positions(whole, "conv_id", ["parent_turn", "turn", "role", "text"], "position")
    return placed.select("conv_id", "turn", "role", "parent_turn", "position", "n_quotes", "n_linked",
                         "max_level", "text")
