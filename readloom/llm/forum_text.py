"""Forum posts without what is not their words: small per-text helpers for Arrow tasks."""

from __future__ import annotations

import html
import re
import unicodedata

#: An ampersand that was written as an entity again and again: resolved in one step.
_NESTED = re.compile(r"&(?:(?:amp|AMP|#0*38|#[xX]0*26);)+")
_BREAKING = re.compile(r"<\s*/?\s*(?:br|p|div|blockquote|li|ul|ol|tr|td|table|h[1-6]|hr|pre)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[^<>\n]+>")
_BREAKING_CODE = re.compile(r"\[/?(?:quote|code|list|\*)(?:=[^\[\]\n]*)?\]", re.I)
_CODE = re.compile(r"\[/?[A-Za-z*]+(?:=[^\[\]\n]*)?\]")
_QUOTE_MARKS = re.compile(r"^[ \t]*(?:[>|»][ \t]*)+", re.M)
_SPLIT_WORD = re.compile(r"(?<=[^\W\d_])[-­‐‑][ \t]*\n[ \t]*(?=[^\W\d_])")
_WORD = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]|[^\W_぀-ヿ㐀-鿿豈-﫿]+")
_ADDRESS = re.compile(r"(?:https?|ftp)://\S+|www\.\S+|(?<!\S)\S+@\S+\.\w+", re.I)
_SIGNATURE = re.compile(r"^--[ \t]*$", re.M)
_SMALL_PRINT = re.compile(r"\[size=1\].*?\[/size\]", re.I | re.S)
_URL_TAG = re.compile(r"\[url=[^\]\n]*\]", re.I)
_SIGNATURE_LINE = re.compile(r"^~.*$", re.M)
_HEADER = re.compile(r"^[ \t]*[\w.-]+:[ \t]*$", re.M)
_MODERATED = re.compile(r"^[ \t]*\*{2,}[^\n]*\*{2,}[ \t]*$", re.M)


#: Characters of the Unicode category of format signs, as ranges.
_FORMAT = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xAD, 0xAD), (0x600, 0x605), (0x61C, 0x61C), (0x6DD, 0x6DD), (0x70F, 0x70F), (0x180E, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x2064), (0x2066, 0x206F), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFB), (0xE0001, 0xE0001), (0xE0020, 0xE007F))) + "]")


def _plain(text: str) -> str:
    """Entities resolved, however deep they are nested, and line ends made alike."""
    while "&" in text and (once := html.unescape(_NESTED.sub("&", text))) != text:
        text = once
    return text.replace("\r\n", "\n").replace("\r", "\n")


def _invisible(text: str) -> str:
    return text if text.isascii() else _FORMAT.sub("", text)


def _without(pattern: re.Pattern, by: str, text: str, *signs: str) -> str:
    """``pattern.sub(by, text)``, looked for only where one of the signs stands that each match holds."""
    return pattern.sub(by, text) if any(x in text for x in signs) else text


def _without_markup(text: str) -> str:
    text = _without(_TAG, "", _without(_BREAKING, "\n", text, "<"), "<")
    return _without(_QUOTE_MARKS, "", _without(_CODE, "", _without(_BREAKING_CODE, "\n", text, "["), "["), ">", "|", "»")


def _without_splits(text: str) -> str:
    return _without(_SPLIT_WORD, "", text, "-", "\xad", "\u2010", "\u2011") if "\n" in text else text


def words(text: str | None) -> list[str]:
    """The words as they are compared: without case, punctuation, markup, entities, quote marks, line
    breaks, splits at line ends, invisible characters and compatibility forms. A Han or kana letter is a word."""
    if not text:
        return []
    text = _without_markup(_plain(text))
    text = _without_splits(text)
    return _WORD.findall(_invisible(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())))


def running_text(text: str | None) -> str:
    """A post's running text: without markup, addresses, signatures, quote headers and marks of deleted posts."""
    if not text:
        return ""
    text = _plain(text)
    if "--" in text and (cut := _SIGNATURE.search(text)):
        text = text[: cut.start()]
    text = _without(_URL_TAG, "", _without(_SMALL_PRINT, "\n", text, "["), "[")
    if "@" in text or "://" in text or "www." in text.lower():
        text = _ADDRESS.sub(" ", text)
    text = _without(_HEADER, "", _without_markup(text), ":")
    text = _without(_SIGNATURE_LINE, "", _without(_MODERATED, "", text, "**"), "~")
    return _invisible(unicodedata.normalize("NFKC", _without_splits(text)))


_EMPTY_LINE = re.compile(r"\n[ \t]*\n")
_LINE_END = re.compile(r"\s*\n\s*")
_SENTENCE_END = re.compile(r"[.!?…][\"')\]]*\s+|[。！？]")


def sentences(text: str, longest: int = 300) -> list[str]:
    """Pieces of running text between sentence ends and empty lines; lines of a paragraph are joined.

    Pieces beyond ``longest`` letters are divided at blanks where there are any, else anywhere."""
    out = []
    for paragraph in _EMPTY_LINE.split(text):
        paragraph = _without(_LINE_END, " ", paragraph, "\n").strip()
        begin = 0
        for end in [*_SENTENCE_END.finditer(paragraph), None]:
            s = paragraph[begin : end.start() + 1] if end else paragraph[begin:]
            begin = end.end() if end else begin
            while s and len(s) > longest:
                at = s.rfind(" ", longest // 2, longest) + 1 or longest
                out.append(s[:at])
                s = s[at:]
            if s and s.strip():
                out.append(s)
    return out
