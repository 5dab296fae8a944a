"""BibTeX entries as APA references: strings and joins, nested braces, parts of names, LaTeX accents.

Reading is a small parser that runs in Arrow batches, an entry a row; nothing in Spark's functions nests braces.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: LaTeX's accents as combining characters, its letters, and BibTeX's names of months.
ACCENTS = {"`": "\u0300", "'": "\u0301", "^": "\u0302", "~": "\u0303", "=": "\u0304", "u": "\u0306", ".": "\u0307", '"': "\u0308", "r": "\u030a", "H": "\u030b", "v": "\u030c", "d": "\u0323", "c": "\u0327", "k": "\u0328", "b": "\u0331"}
LETTERS = {"ss": "ß", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "aa": "å", "AA": "Å", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "i": "ı", "j": "ȷ", "dh": "ð", "DH": "Ð", "th": "þ", "TH": "Þ", "textendash": "–", "textemdash": "—"}
MONTHS = {m: m.capitalize() for m in "jan feb mar apr may jun jul aug sep oct nov dec".split()}

KINDS = "struct<key: string, kind: string, apa: string, error: string>"
ARROW = pa.struct([("key", pa.string()), ("kind", pa.string()), ("apa", pa.string()), ("error", pa.string())])
#: A reference names so many authors at most; of more, all but one of these and the last.
MOST_AUTHORS = 20


class Malformed(ValueError):
    """What is wrong with a text, and where."""


@dataclass
class Entry:
    kind: str
    key: str
    fields: dict[str, str] = field(default_factory=dict)


class Reader:
    """Entries of a text, in order; what stands between them is a comment."""

    def __init__(self, text: str):
        self.text, self.at, self.strings = text, 0, dict(MONTHS)

    def fail(self, what: str) -> Malformed:
        return Malformed(f"{what} at {self.at}")

    def skip(self) -> str:
        """The next character that isn't a space; empty at the end."""
        while self.at < len(self.text) and self.text[self.at].isspace():
            self.at += 1
        return self.text[self.at : self.at + 1]

    def take(self, pattern: str, what: str) -> str:
        self.skip()
        m = re.compile(pattern).match(self.text, self.at)
        if not m:
            raise self.fail(f"no {what}")
        self.at = m.end()
        return m[0]

    def braced(self, close: str) -> str:
        """What stands before ``close``, outside any braces that are opened; the place is then behind it."""
        begin, depth = self.at, 0
        while self.at < len(self.text):
            c = self.text[self.at]
            if c == "\\":
                self.at += 1
            elif depth == 0 and c == close:
                self.at += 1
                return self.text[begin : self.at - 1]
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if depth < 0:
                    raise self.fail("a brace too many")
            self.at += 1
        raise self.fail(f"no closing {close}")

    def value(self) -> str:
        """A number, a string's name, or a text in braces or quotes; several are joined by ``#``."""
        out = ""
        while True:
            c = self.skip()
            if c in ("{", '"') and c:
                self.at += 1
                out += self.braced("}" if c == "{" else '"')
            else:
                word = self.take(r'[^\s,#{}"()=%]+', "value")
                if not word.isdigit() and word.lower() not in self.strings:
                    raise self.fail(f"unknown string {word}")
                out += word if word.isdigit() else self.strings[word.lower()]
            if self.skip() != "#":
                return out
            self.at += 1

    def fields(self, close: str) -> dict[str, str]:
        out: dict[str, str] = {}
        while (c := self.skip()) != close:
            if not c:
                raise self.fail("the entry ends early")
            name = self.take(r"[^\s=,{}\"#%()]+", "field").lower()
            self.take("=", "=")
            told = self.value()
            out.setdefault(name, told)
            if self.skip() == ",":
                self.at += 1
            elif self.skip() != close:
                raise self.fail("no comma")
        self.at += 1
        return out

    def entries(self) -> list[Entry]:
        out = []
        while (at := self.text.find("@", self.at)) >= 0:
            self.at = at + 1
            kind = self.take(r"[A-Za-z]+", "kind of entry").lower()
            close = "}" if self.take(r"[{(]", "opening brace") == "{" else ")"
            if kind == "comment" or kind == "preamble":
                self.braced(close)
            elif kind == "string":
                self.strings |= self.fields(close)
            else:
                key = self.take(r"[^\s,{}()\"#%=]+", "key")
                if self.skip() == ",":
                    self.at += 1
                elif self.skip() != close:
                    raise self.fail("no comma after the key")
                out.append(Entry(kind, key, self.fields(close)))
        return out


def plain(text: str) -> str:
    """LaTeX's text as characters: accents, letters, escaped marks and dashes; other commands and all braces go, spaces are single."""

    def accent(m: re.Match) -> str:
        letter = {"\\i": "i", "\\j": "j"}.get(m[2], m[2])
        return unicodedata.normalize("NFC", letter + ACCENTS[m[1]])

    letter = r"(\\[ij](?![A-Za-z])|[A-Za-z])"
    text = re.sub(r"\\([`'^~=.\"])\s*\{?\s*" + letter + r"\s*\}?", accent, text)
    text = re.sub(r"\\([uvHcdbkr])(?:\s*\{\s*|\s+)" + letter + r"\s*\}?", accent, text)
    text = re.sub(r"\\([A-Za-z]+)(?:\s+|\{\}|(?![A-Za-z]))", lambda m: LETTERS.get(m[1], ""), text)
    text = re.sub(r"\\([&%$#_{}])", lambda m: {"{": "\ue000", "}": "\ue001"}.get(m[1], m[1]), text)
    text = text.replace("---", "—").replace("--", "–").replace("~", " ").replace("\\", "")
    text = text.replace("{", "").replace("}", "").replace("\ue000", "{").replace("\ue001", "}")
    return " ".join(text.split())


def outside_braces(text: str, separator: str) -> list[str]:
    """``text`` split at the pattern ``separator`` where no brace is open."""
    depth, parts, begin, at = 0, [], 0, 0
    pattern = re.compile(separator)
    while at < len(text):
        m = pattern.match(text, at) if depth == 0 else None
        if m:
            parts.append(text[begin:at])
            begin = at = m.end()
            continue
        depth += {"{": 1, "}": -1}.get(text[at], 0)
        at += 2 if text[at] == "\\" else 1
    return [*parts, text[begin:]]


def name_of(text: str) -> tuple[str, list[str], str]:
    """(last name with what belongs before it, first names, suffix) of a person: ``First von Last``, ``von Last, First`` or ``von Last, Jr, First``."""
    parts = [p.strip() for p in outside_braces(text, ",")]
    if len(parts) == 1:
        words = outside_braces(parts[0], r"[\s~]+")
        small = [k for k, w in enumerate(words[:-1]) if plain(w)[:1].islower()]
        cut = small[0] if small else len(words) - 1
        return plain(" ".join(words[cut:])), [plain(w) for w in words[:cut]], ""
    first = outside_braces(parts[-1], r"[\s~]+") if parts[-1] else []
    return plain(parts[0]), [plain(w) for w in first], plain(parts[1]) if len(parts) > 2 else ""


def person(text: str) -> str:
    last, first, suffix = name_of(text)
    initials = " ".join("-".join(f"{p[0]}." for p in w.split("-") if p) for w in first if w)
    return ", ".join(x for x in (last, initials, suffix) if x)


def people(text: str) -> str:
    told = [person(p.strip()) for p in outside_braces(text, r"\s+and\s+") if p.strip()]
    told = ["et al." if t in ("others", "et al.") else t for t in told]
    if len(told) > MOST_AUTHORS:
        return ", ".join(told[: MOST_AUTHORS - 1]) + ", ... " + told[-1]
    if len(told) > 1 and told[-1] != "et al.":
        return ", ".join(told[:-1]) + ", & " + told[-1]
    return ", ".join(told)


def apa(entry: Entry) -> str:
    """``Authors (year). Title. Journal, volume(number), pages. https://doi.org/...``; what is missing is left out, a missing year is n.d."""
    get = lambda *names: next((plain(entry.fields[n]) for n in names if entry.fields.get(n, "").strip()), "")
    raw = next((entry.fields[n] for n in ("author", "editor") if entry.fields.get(n, "").strip()), "")
    title = get("title").rstrip(".")
    out = " ".join(x for x in (people(raw), f"({get('year') or 'n.d.'}).") if x)
    out += f" {title}." if title else ""
    source = get("journal", "booktitle", "publisher", "school", "institution", "howpublished")
    if volume := get("volume"):
        source += (", " if source else "") + volume + (f"({get('number')})" if get("number") else "")
    if pages := get("pages").replace("-", "–").replace("––", "–"):
        source += (", " if source else "") + pages
    out += f" {source}." if source else ""
    if doi := re.sub(r"^(https?://)?(dx\.)?(doi\.org/|doi:\s*)", "", get("doi"), flags=re.I):
        out += f" https://doi.org/{doi}"
    elif url := get("url"):
        out += f" {url}"
    return out


def told_of(text: str | None) -> dict | None:
    """key, kind and apa of the one entry of a text, or error; None for a null or blank text."""
    if text is None or not text.strip():
        return None
    try:
        found = Reader(text).entries()
        if len(found) != 1:
            raise Malformed(f"{len(found)} entries")
        return {"key": found[0].key, "kind": found[0].kind, "apa": apa(found[0]), "error": None}
    except Malformed as e:
        return {"key": None, "kind": None, "apa": "", "error": str(e)}


def reference(bibtex: Column) -> Column:
    """struct<key, kind, apa, error> of a BibTeX text of one entry; of a malformed one, or of none or several entries, an empty apa and what is wrong; null without text."""

    @F.arrow_udf(KINDS)
    def read(texts: pa.Array) -> pa.Array:
        return pa.array([told_of(t) for t in texts.to_pylist()], ARROW)

    return read(bibtex)
