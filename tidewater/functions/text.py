"""String columns: phone masking, composite document ids, search tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._util import col as _col

# Fixed values that must equal the reference's output.
PHONE_KEEP = 4            # characters kept at the front of a phone number
PHONE_MASK = "*******"    # seven stars, whatever the length of the number

# Token boundary of the simple analyzer: anything that is not a letter or digit.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
# Scripts written without spaces between words (and the long vowel mark of two of them).
SPACELESS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\u30FC\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
SCRIPT_RUN = rf"[{SPACELESS}]+|[\p{{L}}\p{{N}}&&[^{SPACELESS}]]+"


def mask_phone(tel) -> Column:
    """First four characters followed by seven ``*`` (null stays null)."""
    return F.concat(F.substring(_col(tel), 1, PHONE_KEEP), F.lit(PHONE_MASK))


def doc_id(sep: str, *parts) -> Column:
    """Composite document id, e.g. ``mid-HH:mm`` or ``order_detail``."""
    return F.concat_ws(sep, *[_col(p) for p in parts])


def tokens(text) -> Column:
    """Lower-cased distinct word tokens of a text (empty tokens dropped)."""
    return F.array_distinct(
        F.filter(F.split(F.lower(_col(text)), TOKEN_SPLIT), lambda t: t != F.lit(""))
    )


def token_list(text) -> Column:
    """Lower-cased word tokens with repeats (term frequency and doc length)."""
    return F.filter(F.split(F.lower(_col(text)), TOKEN_SPLIT), lambda t: t != F.lit(""))


def all_tokens_match(text, keyword: str) -> Column:
    """Every token of ``keyword`` occurs in ``text``; an empty keyword matches nothing."""
    kw = tokens(F.lit(keyword))
    return (F.size(kw) > 0) & (F.size(F.array_except(kw, tokens(text))) == 0)


def script_runs(text) -> Column:
    """Lower-cased words of a text; where a script has no spaces, its whole runs."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(SCRIPT_RUN), F.lit(0))


def _run_tokens(run: Column, singles: bool) -> Column:
    """A run's overlapping pairs of characters, with each character too (``singles``) or only
    where it is the whole run; a word is one token."""
    chars = F.regexp_extract_all(run, F.lit(r"(?s)."), F.lit(0))
    n = F.size(chars)
    pairs = F.zip_with(F.slice(chars, F.lit(1), n - 1), F.slice(chars, F.lit(2), n - 1), lambda a, b: F.concat(a, b))
    cut = F.concat(chars, pairs) if singles else F.when(n > 1, pairs).otherwise(chars)
    return F.when(run.rlike(f"^[{SPACELESS}]"), cut).otherwise(F.array(run))


def script_tokens(text) -> Column:
    """Tokens of a text to be searched, with repeats: words; of scripts without spaces every
    character and every two neighbours.  Without such scripts the same as ``token_list``."""
    return F.flatten(F.transform(script_runs(text), lambda r: _run_tokens(r, True)))


def script_keyword_tokens(text) -> Column:
    """Distinct tokens that a text must have to match a keyword: the pairs of a run (its
    character, if it is one), so characters must be neighbours in the text as well."""
    return F.array_distinct(F.flatten(F.transform(script_runs(text), lambda r: _run_tokens(r, False))))


def all_script_tokens_match(text, keyword: str) -> Column:
    """``all_tokens_match`` for scripts without spaces too."""
    kw = script_keyword_tokens(F.lit(keyword))
    return (F.size(kw) > 0) & (F.size(F.array_except(kw, script_tokens(text))) == 0)


def json_field(json_text, path: str) -> Column:
    """One field of a JSON text, e.g. ``$.type``."""
    return F.get_json_object(_col(json_text), path)
