"""Text and identifier expressions. All are built-in functions of Spark; only to_ascii needs a Python worker, for scripts other than Latin."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_BASE = 10_000_000_000


# ---- folding to ASCII ----


def _latin() -> tuple[str, str]:
    """Latin letters U+00C0 to U+017F and the ASCII letter under their marks."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x180)]
    pairs = [(a, b) for a, b in pairs if b.isascii() and a != b and b.isalpha() and unicodedata.normalize("NFKD", a)[1:2] and unicodedata.combining(unicodedata.normalize("NFKD", a)[1])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


LATIN, LATIN_TO = _latin()
#: Latin letters that are no letter with a mark.
LATIN_MORE = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "þ": "th", "ð": "d", "Æ": "AE", "Œ": "OE", "Ø": "O", "Đ": "D", "Ł": "L", "Þ": "TH", "Ð": "D", "ı": "i"}


def fold_latin(c: Column) -> Column:
    """Latin letters without their marks; other characters stay. Texts in ASCII are passed as they are."""
    folded = F.translate(c, LATIN, LATIN_TO)
    for a, b in LATIN_MORE.items():
        folded = F.replace(folded, F.lit(a), F.lit(b))
    return F.when(c.rlike(r"[^\x00-\x7f]"), folded).otherwise(c)


def to_ascii(c: Column) -> Column:
    """Latin letters are folded by built-in functions; what is left outside ASCII is transliterated in Arrow batches."""
    from .transliterate import transliterate

    folded = fold_latin(c)
    other = folded.rlike(r"[^\x00-\x7f]")
    return F.when(other, transliterate(F.when(other, folded))).otherwise(folded)


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^0-9a-z]+", " "))


def basic_normalize(c: Column, ascii_of=fold_latin) -> Column:
    return _clean(ascii_of(c))


def raw_tokens(c: Column) -> Column:
    """Without folding: letters outside ASCII separate tokens."""
    return _clean(c)


# ---- tokens ----


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(c, r"\s+"), "")


def joined(c: Column) -> Column:
    return F.array_join(c, " ")


def join_single_letters(c: Column) -> Column:
    """l l c becomes llc."""
    return F.regexp_replace(c, r"(?<=\b[a-z]) (?=[a-z]\b)", "")


def fix_ocr_token(t: Column) -> Column:
    """Digits that stand for letters inside a word."""
    letters = F.char_length(F.regexp_replace(t, "[^a-z]", ""))
    plain = t.rlike("^[a-z]+$") | t.rlike("^[0-9]+$") | t.rlike("^[0-9]+(st|nd|rd|th)$") | (letters < 2) | t.rlike("[279]")
    return F.when(plain, t).otherwise(F.translate(t, "0134568", "oleasgb"))


def _no_apostrophe(c: Column) -> Column:
    return F.translate(c, "'’", "")


def prenormalize_names(c: Column, ascii_of=fold_latin) -> Column:
    text = basic_normalize(F.replace(_no_apostrophe(c), F.lit("&"), F.lit(" and ")), ascii_of)
    return join_single_letters(joined(F.transform(tokens(text), fix_ocr_token)))


def _strip_zeros(t: Column) -> Column:
    return F.regexp_replace(t, "^0+(?=.)", "")


def _address_tokens(text: Column) -> Column:
    kept = F.filter(tokens(text), lambda t: t != "null")
    return F.transform(kept, lambda t: F.when(t.rlike("^[0-9]+$"), _strip_zeros(t)).otherwise(t))


def prenormalize_addresses(c: Column, ascii_of=fold_latin) -> Column:
    return joined(_address_tokens(basic_normalize(_no_apostrophe(c), ascii_of)))


def numbers(c: Column) -> Column:
    """All runs of digits of any script, without leading zeros."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?U)(\d+)"), 1), _strip_zeros)


def first_number(c: Column) -> Column:
    return F.try_element_at(numbers(c), F.lit(1))


def postal_tokens(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?<!\d)(\d{5,6})(?!\d)"), 1))


def components(c: Column, ascii_of=fold_latin) -> Column:
    """Parts of an address between commas, each normalised; empty ones go."""
    text = F.lower(ascii_of(_no_apostrophe(c)))
    parts = F.transform(F.split(text, ","), lambda p: joined(_address_tokens(_clean(p))))
    return F.filter(parts, lambda p: p != "")


def apply_map(toks: Column, mapping: Column) -> Column:
    """Token by token; a token that isn't in the map stays. A null map changes nothing."""
    return F.when(mapping.isNull(), toks).otherwise(F.transform(toks, lambda t: F.coalesce(F.try_element_at(mapping, t), t)))


STOPWORDS = ("the", "and", "of")


def core_tokens(toks: Column, weak: Column) -> Column:
    """Without weak tokens and stop words; all of them if nothing would stay."""
    kept = F.filter(toks, lambda t: ~F.array_contains(weak, t) & ~t.isin(*STOPWORDS))
    return F.when(F.size(kept) == 0, toks).otherwise(kept)


def initials(toks: Column) -> Column:
    return F.when(F.size(toks) >= 2, F.array_join(F.transform(toks, lambda t: F.left(t, F.lit(1))), "")).otherwise("")


def is_subsequence(short: Column, long: Column) -> Column:
    chars = F.filter(F.split(short, ""), lambda x: x != "")
    return F.regexp_like(long, F.array_join(chars, ".*"))


def abbreviation_compatible(a: Column, b: Column) -> Column:
    short, long = F.when(F.char_length(a) <= F.char_length(b), a).otherwise(b), F.when(F.char_length(a) <= F.char_length(b), b).otherwise(a)
    words = ~a.rlike("^[0-9]+$") & ~b.rlike("^[0-9]+$")
    return words & (F.left(a, F.lit(1)) == F.left(b, F.lit(1))) & (F.char_length(short) >= 2) & is_subsequence(short, long)


def char_ngrams(word: Column, n: int = 3) -> Column:
    """Grams of a word with a space at both ends; a one-letter word has one."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(padded) - n + 1)), lambda i: F.substring(padded, i, F.lit(n)))


# ---- patterns ----

#: Noise patterns of names and addresses.
NAME_PATTERNS = {
    "non_ascii": r"[^\x00-\x7f]",
    "has_digit": r"\d",
    "ocr_digit_in_word": r"(?i)[a-z][018][a-z]|\b[018][a-z]{3,}",
    "ampersand": r"&",
    "acronym_only": r"^[A-Z]{2,5}$",
    "domain_name": r"(?i)\.(?:com|net|org|in|co|fr|biz|info)\b",
    "alias_marker": r"(?i)\b(?:f/k/a|fka|d/b/a|dba|a/k/a|aka|formerly|t/a)\b",
    "unusual_punct": r"[!?@*$%^_=+~|<>]",
    "multi_space": r"\s{2,}",
    "lead_trail_space": r"^\s|\s$",
}
ADDR_PATTERNS = {
    "empty": r"^\s*$",
    "non_ascii": r"[^\x00-\x7f]",
    "has_digit": r"\d",
    "token_5digit": r"(?<!\d)\d{5}(?!\d)",
    "token_6digit": r"(?<!\d)\d{6}(?!\d)",
    "spaced_pin_ddd_ddd": r"(?<!\d)\d{3} \d{3}(?!\d)",
    "zip_plus4": r"\b\d{5}-\d{4}\b",
    "starts_with_number": r"^\s*#?\s*\d",
    "hash_number": r"#\s?\d",
    "zero_padded_number": r"(?<![\d.])0\d+",
    "landmark_marker": r"(?i)\b(?:near|opp|opposite|behind|beside|next to|nr|adj|adjacent)\b",
    "unit_marker": r"(?i)\b(?:unit|apt|apartment|suite|ste|floor|flr|flat|fl)\b",
    "po_box": r"(?i)\bp\.?\s?o\.?\s?box\b",
    "null_literal": r"(?i)<null>|\bnull\b|\bn/a\b",
}


def flag(c: Column, pattern: str) -> Column:
    return c.rlike(pattern).cast("int")


def case_class(c: Column) -> Column:
    lettered = c.rlike("[A-Za-z]")
    return F.when(lettered & (c == F.upper(c)), "all_upper").when(lettered & (c == F.lower(c)), "all_lower").otherwise("mixed")


# ---- lists and numbers ----


def list_size(c: Column) -> Column:
    """Entries of a comma-separated list; none in an empty one."""
    return F.when(c == "", 0).otherwise(F.size(F.split(c, ",")))


def cardinality_bucket(card: Column) -> Column:
    return F.when(card >= 6, "6+").otherwise(card.cast("string"))


def stratum_key(country: Column, card: Column) -> Column:
    return F.concat_ws("|", country, F.least(card, F.lit(6)).cast("string"))


def safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


# ---- identifiers ----


def encode_id(c: Column) -> Column:
    """S<k>-<n> as k * 10**10 + n; anything else stops the query."""
    code = F.substring(c, 2, 1).cast("long") * ID_BASE + F.substring(c, F.lit(4), F.char_length(c)).cast("long")
    return F.when(c.rlike(r"^S[123]-[0-9]{1,10}$"), code).otherwise(F.raise_error(F.concat(F.lit("no entity id: "), F.coalesce(c, F.lit("null")))).cast("long"))


def decode_id(code: Column) -> Column:
    return F.concat(F.lit("S"), source_of(code).cast("string"), F.lit("-"), (code % ID_BASE).cast("string"))


def source_of(code: Column) -> Column:
    return F.floor(code / ID_BASE).cast("int")
