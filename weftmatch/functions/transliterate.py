"""Transliteration of scripts other than Latin: by letter tables, by the arithmetic of Hangul, from the names of characters."""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _letters(pairs: str) -> dict[str, str]:
    return dict(x.split("=") for x in pairs.split())


#: Letters of alphabets as they are usually written in Latin letters.
LETTERS = {
    **_letters("а=a б=b в=v г=g д=d е=e ё=e ж=zh з=z и=i й=y к=k л=l м=m н=n о=o п=p р=r с=s т=t у=u ф=f х=kh ц=ts ч=ch ш=sh щ=shch ъ= ы=y ь= э=e ю=yu я=ya і=i ї=yi є=ye ґ=g ў=w ђ=dj ј=j љ=lj њ=nj ћ=c џ=dz ѓ=g ќ=k ѕ=dz"),
    **_letters("α=a β=v γ=g δ=d ε=e ζ=z η=i θ=th ι=i κ=k λ=l μ=m ν=n ξ=x ο=o π=p ρ=r σ=s ς=s τ=t υ=y φ=f χ=ch ψ=ps ω=o"),
    **_letters("ա=a բ=b գ=g դ=d ե=e զ=z է=e ը=y թ=t ժ=zh ի=i լ=l խ=kh ծ=ts կ=k հ=h ձ=dz ղ=gh ճ=ch մ=m յ=y ն=n շ=sh ո=o չ=ch պ=p ջ=j ռ=r ս=s վ=v տ=t ր=r ց=ts ւ=w փ=p ք=k և=ev օ=o ֆ=f"),
    **_letters("ა=a ბ=b გ=g დ=d ე=e ვ=v ზ=z თ=t ი=i კ=k ლ=l მ=m ნ=n ო=o პ=p ჟ=zh რ=r ს=s ტ=t უ=u ფ=p ქ=k ღ=gh ყ=q შ=sh ჩ=ch ც=ts ძ=dz წ=ts ჭ=ch ხ=kh ჯ=j ჰ=h"),
    **_letters("א=' ב=v ג=g ד=d ה=h ו=v ז=z ח=h ט=t י=y כ=k ך=k ל=l מ=m ם=m נ=n ן=n ס=s ע=' פ=p ף=f צ=ts ץ=ts ק=q ר=r ש=sh ת=t"),
    **_letters("ا=a آ=a أ=a إ=i ٱ=a ب=b پ=p ت=t ث=th ج=j چ=ch ح=h خ=kh د=d ذ=dh ر=r ز=z ژ=zh س=s ش=sh ص=s ض=d ط=t ظ=z ع=' غ=gh ف=f ق=q ك=k ک=k گ=g ل=l م=m ن=n ه=h ة=h و=w ؤ=w ي=y ی=y ى=a ئ=y ء='"),
    **_letters("シ=shi し=shi チ=chi ち=chi ツ=tsu つ=tsu フ=fu ふ=fu ジ=ji じ=ji ヂ=ji ぢ=ji ヅ=zu づ=zu ッ=tsu っ=tsu ー=- を=o ヲ=o"),
}
#: The first, middle and last sounds of Hangul syllables, in the order of their code points.
HANGUL = (
    "g kk n d tt r m b pp s ss - j jj ch k t p h".split(),
    "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(),
    "- g kk gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j ch k t p h".split(),
)
_NAME = re.compile(r"^(?P<script>[A-Z]+) (?P<kind>LETTER|VOWEL SIGN|SIGN|SMALL LETTER|CAPITAL LETTER|LETTER SMALL|DIGIT) (?P<rest>.+)$")
#: Scripts whose consonants carry an a.
_ABUGIDAS = {"DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM"}
_KANA = {"HIRAGANA", "KATAKANA"}


def _syllable(ch: str) -> str:
    k = ord(ch) - 0xAC00
    return "".join(sounds[i] for sounds, i in zip(HANGUL, (k // 588, k % 588 // 28, k % 28), strict=True)).replace("-", "")


@functools.lru_cache(maxsize=65536)
def _parts(ch: str) -> tuple[str, str]:
    """Script and Latin text of a character. Letters of a script without a rule, as ideographs, become their code point: no name vanishes."""
    if ch.isascii():
        return "", ch
    if "\uac00" <= ch <= "\ud7a3":
        return "HANGUL", _syllable(ch)
    low = ch.lower()
    for known in (low, unicodedata.normalize("NFD", low)[0]):
        if known in LETTERS:
            latin = LETTERS[known]
            return "", latin.capitalize() if ch != low else latin
    plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
    if plain.isascii() and plain:
        return "", plain
    if ch.isdigit():
        return "", str(unicodedata.digit(ch))
    if unicodedata.combining(ch) and not _NAME.match(unicodedata.name(ch, "")):
        return "", ""
    m = _NAME.match(unicodedata.name(ch, ""))
    script, rest = (m["script"], m["rest"].split(" WITH ")[0].lower().split()[-1]) if m else ("", "")
    if script in _KANA:
        return script, rest
    if script in _ABUGIDAS:
        if m["kind"] == "VOWEL SIGN":
            return script, _short(rest)
        if m["kind"] == "LETTER":
            return script, rest[:-1] if rest.endswith("a") and len(rest) > 1 and rest != "aa" else _short(rest)
        return script, "m" if rest in ("anusvara", "candrabindu", "bindi", "tippi") else ""
    return script, f"u{ord(ch):x}" if ch.isalpha() else " " if ch.isspace() else ""


def _short(vowel: str) -> str:
    return re.sub(r"(.)\1+", r"\1", vowel)


def transliterate_text(text: str) -> str:
    """The a that a consonant of an Indic script carries is left out everywhere; doubled letters of a sign become one."""
    parts = (_parts(ch) for ch in unicodedata.normalize("NFKC", text))
    return "".join(_short(latin) if script in _ABUGIDAS else latin for script, latin in parts)


@F.pandas_udf(StringType())
def transliterate(s: pd.Series) -> pd.Series:
    """Null stays null: rows that need nothing are passed as null."""
    return s.map(transliterate_text, na_action="ignore")


@functools.cache
def unicode_script(ch: str) -> str:
    """The first word of a character's Unicode name."""
    return (unicodedata.name(ch, "") or "UNKNOWN").split(" ")[0]
