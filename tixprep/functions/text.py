"""Text scalars: masking, cleaning, tokenizing — chained ``regexp_replace`` expressions.

Character classes are written so that Java regex behaves like Python ``re`` on str patterns:
word = ``[\\p{L}\\p{N}_]``, whitespace = ``[\\s\\x1c-\\x1f\\x85\\p{Z}]``, digit = ``\\p{Nd}``; a
Python ``.`` (anything but a newline) is written ``[^\\n]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tixprep.schema import SEP

# --- fixed patterns --------------------------------------------------------------------------
SPACE_CLASS = r"\s\x1c-\x1f\x85\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"
SPACES = f"[{SPACE_CLASS}]+"
NON_SPACE = f"[^{SPACE_CLASS}]"
# The same matches as ``\S+@\S+``: a run of non-space characters with an @ that is neither its first nor its last
# character matches whole, so only starts of runs are tried and nothing is given back.
EMAIL_LOOSE = f"(?<!{NON_SPACE}){NON_SPACE}[^@{SPACE_CLASS}]*+@{NON_SPACE}++"
# The same matches as ``[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}``: the part before the @ is a whole run of its
# class, or what a match before it has left of one.
EMAIL_STRICT = r"(?:\G|(?<![a-zA-Z0-9._%+-]))[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
URL = f"http{NON_SPACE}+|www[^\\n]{NON_SPACE}+"
NON_WORD_RUN = f"[^{WORD_CLASS}]+"          # punctuation and whitespace together
NON_ASCII_ALNUM_RUN = r"[^a-zA-Z0-9]+"
DIGITS = r"\p{Nd}+"
ASCII_DIGITS = r"[0-9]+"
ALPHA_WORD = r"^\p{L}+$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c) -> Column:
    """Null text becomes the empty string."""
    return F.coalesce(col_(c), F.lit(""))


def mask_email(c, token: str = "EMAIL", strict: bool = False) -> Column:
    c = col_(c)
    pattern = EMAIL_STRICT if strict else EMAIL_LOOSE
    # The contains() guard skips the regex engine for the (vast) majority of texts.
    return F.when(c.contains("@"), F.regexp_replace(c, pattern, token)).otherwise(c)


def mask_url(c, token: str = "URL") -> Column:
    c = col_(c)
    return F.when(c.contains("http") | c.contains("www"), F.regexp_replace(c, URL, token)).otherwise(c)


def mask_digits(c, token: str = "[NUM]", ascii_only: bool = False) -> Column:
    return F.regexp_replace(col_(c), ASCII_DIGITS if ascii_only else DIGITS, token)


def normalize_space(c) -> Column:
    """Collapse every whitespace run to one space and trim (``' '.join(s.split())``)."""
    return F.trim(F.regexp_replace(col_(c), SPACES, " "))


def clean_basic(c) -> Column:
    """Mask email, URL; punctuation to space; digits to [NUM]; collapse; lower case last."""
    t = mask_url(mask_email(nz(c), "EMAIL"), "URL")
    # punctuation->space followed by whitespace collapse == one pass over non-word runs
    t = F.regexp_replace(t, NON_WORD_RUN, " ")
    t = mask_digits(t, "[NUM]")
    return F.lower(F.trim(t))


def clean_profile(c) -> Column:
    """Lower case first, then mask with bracketed tokens (brackets later become spaces)."""
    t = mask_url(mask_email(F.lower(nz(c)), "[EMAIL]"), "[URL]")
    t = F.regexp_replace(t, NON_WORD_RUN, " ")
    t = mask_digits(t, "[NUM]")
    return F.trim(t)


def clean_strict(c) -> Column:
    """ASCII variant: strict email pattern, ASCII letters/digits only, lower case last."""
    t = mask_url(mask_email(nz(c), "EMAIL", strict=True), "URL")
    t = F.regexp_replace(t, NON_ASCII_ALNUM_RUN, " ")
    t = mask_digits(t, "[NUM]", ascii_only=True)
    return F.lower(F.trim(t))


CLEANERS = {"basic": clean_basic, "profile": clean_profile, "strict": clean_strict}


def tokenize_words(c) -> Column:
    """Whitespace split with no empty words (``s.split()``).

    After normalisation words are separated by exactly one space with none at the ends, so a
    plain ``split`` is exact; only the empty text needs care. No lambda: stays in codegen."""
    return words_of_normal(normalize_space(nz(c)))


def words_of_normal(t: Column) -> Column:
    """Words of a normalised text. The empty word of the empty text is taken out, as a test for that text would have the text
    normalised twice."""
    return F.array_remove(F.split(t, " "), "")


def split_fields(c, sep: str = SEP) -> Column:
    """Split the combined text on the field separator (empty fields are kept)."""
    return F.split(col_(c), sep.replace("[", "\\[").replace("]", "\\]"))


def join_words(a) -> Column:
    return F.array_join(col_(a), " ")


def alpha_candidates(words) -> Column:
    """0-based positions of alphabetic words longer than 3 characters.

    The word array is referenced once (an indexed ``transform``), so the cost is linear in the
    number of words."""
    marked = F.transform(col_(words), lambda x, i: F.when(x.rlike(ALPHA_WORD) & (F.length(x) > 3), i))
    return F.filter(marked, lambda v: v.isNotNull())


def char_length_nan(c) -> Column:
    """``astype(str).str.len()``: a missing value counts as the 3 characters of 'nan'."""
    return F.length(F.coalesce(col_(c).cast("string"), F.lit("nan")))


def word_count(c) -> Column:
    return F.size(tokenize_words(c))
