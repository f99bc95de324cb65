"""Text expressions: stripping, tokens, phrases, sentences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once, however often the body and later filters use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_parts(number: Column, size: int) -> Column:
    """Integer division, exact for any id."""
    return F.call_function("div", number, F.lit(size))


def strip(text: Column) -> Column:
    """Remove white space (not only blanks) at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda word: word != "")


def _character_class(characters: str) -> str:
    return "[" + "".join(f"\\{c}" if c.isascii() else c for c in characters) + "]"


def word_tokens(text: Column) -> Column:
    """Lower-case words with punctuation marks, quotes and short endings as tokens of their own.

    Marks and runs of dots or dashes stand alone, a comma or colon does unless a digit follows. A
    quote at either end of a word, a dot at its end and an ending like ``n't`` or ``'s`` are cut off; letters that
    each have a dot (``u.s.``) stay together. A null text gives null.
    """
    spaced = F.regexp_replace(F.lower(text), rf"(\.{{2,}}|-{{2,}}|{_character_class(fixed.SEPARATE_MARKS)})", " $1 ")
    spaced = F.regexp_replace(spaced, r"([,:])(?![0-9])", " $1 ")
    endings = "|".join(e.replace("'", "['’]") for e in fixed.SHORT_ENDINGS)
    layout = rf"(?s)^(['‘’]?)(.*?)({endings})?(\.?)(['’]?)$"

    def cut(word: Column) -> Column:
        lead, stem, ending, dot, tail = (F.regexp_extract(word, layout, n) for n in range(1, 6))
        joined = stem.isin(fixed.JOINED_WORDS)
        first = F.when(joined, F.substring(stem, 1, 3)).otherwise(stem)
        second = F.when(joined, F.substring(stem, 4, 3)).otherwise("")
        parts = F.filter(F.array(lead, first, second, ending, dot, tail), lambda part: part != "")
        return F.when(F.regexp_like(word, F.lit(r"^((\p{L}\.){2,}|\.+)$")), F.array(word)).otherwise(parts)

    return F.flatten(F.transform(F.filter(F.split(spaced, r"\s+"), lambda word: word != ""), cut))


def keywords(text: Column, stop_words: list[str] | None = None) -> Column:
    """Words longer than three characters, repeats kept: parted by white space; with ``stop_words``
    word tokens that are no stop words."""
    words = tokens(text) if stop_words is None else word_tokens(text)
    found = F.filter(words, lambda word: F.length(word) > 3)
    return F.filter(found, lambda word: ~word.isin(stop_words)) if stop_words else found


def _ngrams(words: Column, size: int, longer_than: int, stop_words: list[str]) -> Column:
    def gram(start: Column) -> Column:
        return F.concat_ws(" ", F.slice(words, start, F.lit(size)))

    def wanted(start: Column) -> Column:
        return F.exists(F.slice(words, start, F.lit(size)), lambda word: ~word.isin(stop_words)) & (
            F.length(gram(start)) > longer_than
        )

    starts = F.when(
        F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(F.filter(starts, wanted), gram)


def phrases(text: Column, stop_words: list[str] = fixed.STOP_WORDS) -> Column:
    """Phrases of two word tokens longer than 5 characters, then of three longer than 8,
    each with at least one that is no stop word."""
    return let(
        word_tokens(text),
        lambda words: F.concat(_ngrams(words, 2, 5, stop_words), _ngrams(words, 3, 8, stop_words)),
    )


def sentences(text: Column) -> Column:
    """Pieces between white space that follows a full stop, ! or ?."""
    pieces = F.transform(F.split(text, r"(?<=[.!?])\s+"), strip)
    return F.filter(pieces, lambda piece: piece != "")


def turn_number(text: Column) -> Column:
    found = F.regexp_extract(text, r"Turn (\d+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("bigint"), F.lit(1).cast("bigint"))


def contains_any(text: Column, needles: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(n) for n in needles]), lambda needle: F.contains(text, needle))


def embedding_from_json(text: Column) -> Column:
    return F.from_json(text, "array<float>")


def embedding_from_csv(text: Column) -> Column:
    """Comma separated numbers; null unless every part is a number."""
    numbers = F.transform(F.split(text, ","), lambda part: F.trim(part).try_cast("float"))
    return F.when(~F.exists(numbers, lambda number: number.isNull()), numbers)
