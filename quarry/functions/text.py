"""String and token functions (TXT*). All return Columns; no Python UDF.

Character classes are written with explicit Unicode properties so that the
same pattern means the same thing in Java regex and in RE2 (the oracle):
Java's ``\\w`` is ASCII-only unless ``(?U)`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (values the results depend on).
WORD_CLASS = r"[\p{L}\p{N}_]"
WORD_RE = r"([\p{L}\p{N}_]+)"
WORDPUNCT_RE = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+)"
# Characters the speech preprocessor turns into spaces.
SPEECH_PUNCT = ',.:;[]"?$:-'


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wordpunct_tokens(text) -> Column:
    """TXT1: runs of word characters, or runs of other non-space characters."""
    return F.regexp_extract_all(_c(text), F.lit(WORDPUNCT_RE), 1)


def word_tokens(text, lower: bool = True) -> Column:
    """TXT2 (+TXT5): lower-cased runs of letters, digits and underscore."""
    t = F.lower(_c(text)) if lower else _c(text)
    return F.regexp_extract_all(t, F.lit(WORD_RE), 1)


def preprocess_chars(text, chars: str = SPEECH_PUNCT, lower: bool = True) -> Column:
    """TXT3: each of ``chars`` becomes a space; split on single spaces; drop empties."""
    t = F.lower(_c(text)) if lower else _c(text)
    t = F.translate(t, chars, " " * len(chars))
    return F.filter(F.split(t, " "), lambda x: x != "")


def preprocess_regex(text, pattern: str = r"[^\p{L}\p{N}\s]", lower: bool = True) -> Column:
    """TXT4: matches of ``pattern`` become spaces; split on whitespace runs."""
    t = F.lower(_c(text)) if lower else _c(text)
    t = F.trim(F.regexp_replace(t, pattern, " "))
    return F.filter(F.split(t, r"\s+"), lambda x: x != "")


def token_clean(tokens, min_len_exclusive: int = 2) -> Column:
    """TXT6: keep tokens made only of letters and longer than ``n`` characters."""
    return F.filter(_c(tokens), lambda t: t.rlike(r"^\p{L}+$") & (F.length(t) > min_len_exclusive))


def drop_digit_tokens(tokens) -> Column:
    """TXT7: drop tokens containing any digit."""
    return F.filter(_c(tokens), lambda t: ~t.rlike(r"\p{N}"))


def ascii_fold_strip(token) -> Column:
    """TXT8: keep ASCII characters only, then strip whitespace, '-', '_' at the ends."""
    t = F.regexp_replace(_c(token), r"[^\x00-\x7F]", "")
    t = F.trim(t)
    t = F.btrim(t, F.lit("-"))
    return F.btrim(t, F.lit("_"))


def ascii_fold_tokens(tokens) -> Column:
    """TXT8 over an array, dropping tokens that become empty (q16)."""
    return F.filter(F.transform(_c(tokens), ascii_fold_strip), lambda t: t != "")


def min_length_gate(tokens, min_tokens: int = 12) -> Column:
    """TXT10: NULL when fewer than ``min_tokens`` tokens survive."""
    return F.when(F.size(_c(tokens)) >= min_tokens, _c(tokens))


def join_tokens(tokens, sep: str = " ") -> Column:
    """TXT11: token array -> stored string."""
    return F.array_join(_c(tokens), sep)


def split_tokens(text, sep: str = " ") -> Column:
    """TXT11: stored string -> token array (empty string gives an empty array)."""
    return F.filter(F.split(_c(text), sep), lambda x: x != "")


def remove_newlines(text, glue: bool = False) -> Column:
    """TXT12: newlines become spaces (q5); ``glue=True`` deletes them as the old code did."""
    return F.regexp_replace(_c(text), r"\n", "" if glue else " ")


def friendly_string(year, author, text) -> Column:
    """TXT13: "year author text[1:20]" (characters 2..20 of the text)."""
    return F.concat_ws(" ", _c(year).cast("string"), _c(author), F.substring(_c(text), 2, 19))


def regex_single_match(text, pattern: str, group: int = 1) -> Column:
    """TXT14: the captured value only if the pattern matches exactly once, else NULL.

    ``^`` and ``$`` match at line breaks and ``.`` matches a line break.
    """
    m = F.regexp_extract_all(_c(text), F.lit(f"(?sm){pattern}"), group)
    return F.when(F.size(m) == 1, F.get(m, 0))


PRICE_PATTERNS = {"pcm": r"([0-9,]+) pcm", "pw": r"([0-9,]+) pw"}


def parse_price(text, unit: str = "pcm") -> Column:
    """TXT15: digits and commas before a unit, exactly one match, as int."""
    v = regex_single_match(text, PRICE_PATTERNS[unit])
    return _try_int(F.regexp_replace(v, ",", ""))


def _try_int(c: Column) -> Column:
    return c.try_cast("int")


def url_param(url, key: str) -> Column:
    """TXT16: value of ``key=`` in a URL, exactly one match, as double."""
    return regex_single_match(url, rf"[?&]{key}=([^&#]*)").try_cast("double")


def clean_string(s) -> Column:
    """TXT17: NULL -> '', quotes removed."""
    return F.coalesce(F.translate(_c(s), "'\"", ""), F.lit(""))


def text_bar(value, per_star: float = 32.0) -> Column:
    """TXT19: one '*' per ``per_star`` units (truncated, never negative)."""
    n = F.greatest(F.lit(0), (_c(value) / F.lit(per_star)).cast("int"))
    return F.repeat(F.lit("*"), n)


def right_justify(s, width: int = 15) -> Column:
    """TXT19: pad on the left to ``width``; longer strings stay as they are."""
    v = _c(s).cast("string")
    return F.lpad(v, F.greatest(F.length(v), F.lit(width)), F.lit(" "))


def strip_dictionary_suffix(word) -> Column:
    """TXT20 + SRC5: drop trailing '#' and digits, lower-case."""
    return F.lower(F.regexp_replace(_c(word), r"[#0-9]+$", ""))
