"""Text expressions. All of them run inside the JVM, on the whole text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word pattern and time formats.
WORD_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{M}\p{N}_]*(?:['’][\p{L}\p{N}_][\p{L}\p{M}\p{N}_]*)*"
# Character classes of the Unicode word-break rule (UAX #29).
MID_LETTER = ":\u00b7\u0387\u055f\u05f4\u2027\ufe13\ufe55\uff1a"
MID_NUM = ",;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b"
MID_NUM_LET = ".'\u2018\u2019\u2024\ufe52\uff07\uff0e"
LONGEST_WORD = 255
MILLIS_FORMAT = "yyyyMMddHHmmssSSS"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def words(text: Column | str, pattern: str = WORD_PATTERN) -> Column:
    """Lower-cased words of a text, in order; empty for an empty or missing text."""
    known = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_extract_all(F.lower(known), F.lit(pattern), F.lit(0))


def unicode_word_pattern() -> str:
    """Words by the Unicode word-break rule, as one pattern.

    Letters, digits and connectors that touch are one word. A dot, an apostrophe
    or a colon between two letters, and a dot or a comma between two digits, stand
    inside it. Marks and format signs belong to what they follow. Ideographs and
    Hiragana are words of one sign, Katakana runs are one word.
    """
    extend = r"[\p{M}\p{Cf}]*+"
    single, katakana = r"[\p{IsHan}\p{IsHiragana}]", r"[\p{IsKatakana}\u30fc\uff70]"
    letter = rf"(?:[\p{{L}}\p{{Nl}}&&[^\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}\u30fc\uff70]]{extend})"
    digit, connector = rf"(?:\p{{Nd}}{extend})", rf"(?:\p{{Pc}}{extend})"
    between_letters, between_digits = f"[{MID_LETTER}{MID_NUM_LET}]{extend}", f"[{MID_NUM}{MID_NUM_LET}]{extend}"
    letters = f"{letter}++(?:{between_letters}{letter}++)*+"
    digits = f"{digit}++(?:{between_digits}{digit}++)*+"
    return rf"(?:{connector}*+(?:{letters}|{digits}))++{connector}*+|(?:{katakana}{extend})++|{single}{extend}"


def unicode_words(text: Column | str) -> Column:
    """Lower-cased words of a text by the Unicode word-break rule; what is longer than 255 characters is cut there.

    Without the rules for quotes in Hebrew and for emoji. Scripts without blanks
    other than Han and kana come in runs of letters.
    """
    found = words(text, unicode_word_pattern())
    pieces = F.transform(
        found,
        lambda w: F.transform(
            F.sequence(F.lit(0), F.floor((F.length(w) - 1) / LONGEST_WORD)),
            lambda i: F.substring(w, (i * LONGEST_WORD + 1).cast("int"), F.lit(LONGEST_WORD)),
        ),
    )
    return F.flatten(pieces)


def lines(text: Column) -> Column:
    """Lines as a line reader yields them: a final line end adds no line."""
    unified = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n|\r", "\n")
    split = F.split(F.regexp_replace(unified, r"\n\z", ""), "\n")
    return F.when(F.length(unified) == 0, F.array().cast("array<string>")).otherwise(split)


def line_count(text: Column) -> Column:
    return F.size(lines(text))


def join_lines(text: Column) -> Column:
    """All lines, with one blank between them."""
    return F.array_join(lines(text), " ")


def top_lines(text: Column, n: int) -> Column:
    """The first ``n`` lines, or all of a shorter text, with one blank between them."""
    return F.array_join(F.slice(lines(text), 1, n), " ")


def bottom_lines(text: Column, n: int) -> Column:
    """The last ``n`` lines, or all of a shorter text, with one blank between them."""
    all_lines = lines(text)
    start = F.greatest(F.size(all_lines) - n + 1, F.lit(1))
    return F.array_join(F.slice(all_lines, start, F.lit(n)), " ")


def clean_query(text: Column) -> Column:
    """Query text without round brackets, lower-cased."""
    return F.lower(F.regexp_replace(text, "[()]", ""))


def _in_utc(ts: Column) -> Column:
    return F.to_utc_timestamp(ts, F.current_timezone())


def to_millis_key(ts: Column) -> Column:
    """Sortable UTC text of a timestamp, to the millisecond."""
    return F.date_format(_in_utc(ts), MILLIS_FORMAT)


def iso_time(ts: Column) -> Column:
    """ISO-8601 text of a timestamp, in UTC."""
    return F.date_format(_in_utc(ts), ISO_FORMAT)
