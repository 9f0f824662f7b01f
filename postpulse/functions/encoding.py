"""Repair of badly encoded text: the part that columns can express, plus NFC."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What bytes 0x80-0x9F mean in Windows-1252 (five bytes are unassigned).
CP1252_BYTES = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
CP1252_CHARS = CP1252_BYTES.decode("cp1252")
LATIN1_CONTROLS = CP1252_BYTES.decode("latin-1")

# Entities undone, ampersand last so that each is undone only once.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&nbsp;", "\xa0"), ("&amp;", "&"),
)
LIGATURES = (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬅ", "ſt"), ("ﬆ", "st"))
QUOTES_FROM = "ʼ‘’‚‛“”„‟"
QUOTES_TO = "'''''" + '""""'
# Full-width forms U+FF01-FF5E and the ideographic space.
WIDE_FROM = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
WIDE_TO = "".join(chr(0x21 + i) for i in range(94)) + " "
LINE_BREAK = r"\r\n|[\r\x85\x{2028}\x{2029}]"
CONTROL = r"[\x00-\x08\x0b\x0e-\x1f\x7f\x{206a}-\x{206f}\x{feff}\x{fff9}-\x{fffc}]"

# Latin-1 text in which a UTF-8 lead byte is followed by a continuation byte, and the same before Windows-1252 characters are put back.
ALL_LATIN1 = r"^[\x00-\x{FF}]*$"
LEAD_THEN_TAIL = r"[\x{C2}-\x{F4}][\x{80}-\x{BF}]"
LEAD_THEN_CHAR = LEAD_THEN_TAIL[:-1] + CP1252_CHARS + "]"
# Texts without such a character need none of the character steps: plain ASCII and Western
# letters. Few ranges, because every character of every text is tested against each; single characters are looked up at once.
UNUSUAL = "[" + "".join(rf"\x{c:02x}" for c in (*range(0x0A), *range(0x0B, 0x20), *range(0x7F, 0xA0))) + r"\x{02bc}-\x{10FFFF}]"
# No other character changes under NFC or combines with a neighbour.
NFC_CANDIDATE = r"[\x{0300}-\x{200F}\x{2126}-\x{10FFFF}]"


def is_ascii(text: Column) -> Column:
    """One byte per character. Far cheaper than a search for a character class."""
    return F.octet_length(text) == F.length(text)


def unescape_entities(text: Column) -> Column:
    """Undo HTML entities, unless the text looks like markup."""
    plain = text
    for entity, char in ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(F.contains(text, F.lit("&")) & ~F.contains(text, F.lit("<")), plain).otherwise(text)


def repair_mojibake(df: DataFrame, name: str) -> DataFrame:
    """UTF-8 that was once decoded as Latin-1 or Windows-1252, decoded properly.

    Only texts whose every character fits one byte, and whose bytes are valid UTF-8, change.
    """
    narrow, raw = F.col("_narrow"), F.col("_raw")
    suspect = F.regexp_like(narrow, F.lit(ALL_LATIN1))
    return (
        df.withColumn(
            "_narrow",
            F.when(
                ~is_ascii(F.col(name)) & F.regexp_like(F.col(name), F.lit(LEAD_THEN_CHAR)), F.translate(F.col(name), CP1252_CHARS, LATIN1_CONTROLS)
            ),
        )
        # encode() raises on a character that does not fit, so only suspects may reach it.
        .withColumn("_raw", F.encode(F.when(suspect, narrow), "ISO-8859-1"))
        .withColumn(name, F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(F.col(name)))
        .drop("_narrow", "_raw")
    )


def simplify_characters(text: Column) -> Column:
    """Ligatures, full-width forms, curly quotes, line breaks, control characters."""
    for ligature, letters in LIGATURES:
        text = F.replace(text, F.lit(ligature), F.lit(letters))
    text = F.translate(text, WIDE_FROM + QUOTES_FROM, WIDE_TO + QUOTES_TO)
    text = F.regexp_replace(text, LINE_BREAK, "\n")
    return F.regexp_replace(text, CONTROL, "")


def repair_encoding(df: DataFrame, name: str) -> DataFrame:
    """Repair the text column ``name``. Each step is a projection of its own: as one nested
    expression, a step that reads its input several times would repeat all the steps below."""
    df = repair_mojibake(df.withColumn(name, unescape_entities(F.col(name))), name)
    unusual = F.regexp_like(F.col(name), F.lit(UNUSUAL))
    return df.withColumn(name, F.when(unusual, simplify_characters(F.col(name))).otherwise(F.col(name)))


def normalize_nfc(text: Column) -> Column:
    """Unicode composition, which Spark has no function for. Texts that cannot change are
    passed to Python as NULL, so that only the few others cross the Arrow boundary."""

    # Defined here, the function travels to the workers by value and needs no package there.
    @F.pandas_udf(StringType())
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    candidate = ~is_ascii(text) & F.regexp_like(text, F.lit(NFC_CANDIDATE))
    return F.coalesce(compose(F.when(candidate, text)), text)
