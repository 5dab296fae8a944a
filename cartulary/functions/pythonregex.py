"""Python's regular expressions in Java's syntax, so that patterns written for one match the same in a plan.

The pattern is read by Python's own parser; each construct is then written as what means the same to Java: words, digits and
spaces of all of Unicode, ``.``, ``$`` and line starts that know only ``\\n``, named groups, references, conditions on a group, flags for a
part.  What Java can't say raises ``Untranslatable``, which names the construct.
"""

from __future__ import annotations

import re
import sys
import warnings
from dataclasses import dataclass, field
from functools import lru_cache
from re import _constants as c
from re import _parser

#: What Python means by a word's characters, digits and spaces; each may stand inside brackets.
UNICODE = {c.CATEGORY_DIGIT: r"\p{Nd}", c.CATEGORY_WORD: r"\p{L}\p{N}_", c.CATEGORY_SPACE: r"\t-\r\x1c-\x20\x85\p{Z}"}
ASCII = {c.CATEGORY_DIGIT: "0-9", c.CATEGORY_WORD: "a-zA-Z0-9_", c.CATEGORY_SPACE: r"\t-\r\x20"}
NOT = {c.CATEGORY_NOT_DIGIT: c.CATEGORY_DIGIT, c.CATEGORY_NOT_WORD: c.CATEGORY_WORD, c.CATEGORY_NOT_SPACE: c.CATEGORY_SPACE}
EVERY = "(?s:.)"
#: Before 3.14, Python finds no place without a border in an empty text.
NO_EMPTY = "" if sys.version_info >= (3, 14) else r"(?!\A\z)"


class Untranslatable(ValueError):
    """A construct that Java's patterns lack."""


@dataclass(frozen=True)
class JavaPattern:
    """``groups``: the number that each of Python's groups has in ``regex``; ``names``: the number of each named one."""

    regex: str
    groups: dict[int, int] = field(default_factory=dict)
    names: dict[str, int] = field(default_factory=dict)


def letter(code: int) -> str:
    """A character, quoted unless it is a letter or digit."""
    return chr(code) if code < 128 and chr(code).isalnum() else f"\\x{{{code:x}}}"


class Writer:
    def __init__(self, tested: set[int]):
        self.tested, self.made, self.groups = tested, 0, {}

    def write(self, items, flags: int) -> str:
        return "".join(self.one(op, value, flags) for op, value in items)

    def one(self, op, value, flags: int) -> str:  # noqa: C901, PLR0911, PLR0912  (a construct a line)
        kinds = ASCII if flags & re.ASCII else UNICODE
        match op:
            case c.LITERAL:
                return letter(value)
            case c.NOT_LITERAL:
                return f"[^{letter(value)}]"
            case c.ANY:
                return EVERY if flags & re.DOTALL else r"[^\n]"
            case c.IN:
                return self.members(value, kinds)
            case c.CATEGORY:
                return self.members([(op, value)], kinds)
            case c.BRANCH:
                return f"(?:{'|'.join(self.write(b, flags) for b in value[1])})"
            case c.AT:
                return self.place(value, flags, kinds[c.CATEGORY_WORD])
            case c.MAX_REPEAT | c.MIN_REPEAT | c.POSSESSIVE_REPEAT:
                low, high, body = value
                times = f"{{{low},{'' if high is c.MAXREPEAT else high}}}"
                return f"(?:{self.write(body, flags)}){times}" + {c.MAX_REPEAT: "", c.MIN_REPEAT: "?", c.POSSESSIVE_REPEAT: "+"}[op]
            case c.ATOMIC_GROUP:
                return f"(?>{self.write(value, flags)})"
            case c.SUBPATTERN:
                return self.group(*value, flags)
            case c.ASSERT | c.ASSERT_NOT:
                before = dict(self.groups)
                text = f"(?{'<' if value[0] < 0 else ''}{'=' if op is c.ASSERT else '!'}{self.write(value[1], flags)})"
                self.groups = self.groups if op is c.ASSERT else before  # what is found in what must not follow is nothing outside
                return text
            case c.GROUPREF:
                if value not in self.groups:
                    raise Untranslatable(f"a reference to group {value} from where it has no text")
                return f"(?:\\{self.groups[value]})"
            case c.GROUPREF_EXISTS:
                number, yes, no = value
                if number not in self.groups:
                    raise Untranslatable(f"a condition on group {number} from where it has no text")
                mark = f"(?:\\{self.groups[number] + self.marks[number]})"
                return f"(?:{mark}{self.write(yes, flags)}|(?!{mark}){self.write(no, flags) if no is not None else ''})"
            case c.FAILURE:
                return "(?!)"
        raise Untranslatable(f"the construct {op}")

    marks: dict[int, int] = {}

    def members(self, items, kinds: dict) -> str:
        """Brackets; classes that are themselves negations stand beside them, since Java joins those otherwise."""
        negated = items[0][0] is c.NEGATE
        inside, beside = "", []
        for op, value in items[negated:]:
            match op:
                case c.LITERAL:
                    inside += letter(value)
                case c.RANGE:
                    inside += f"{letter(value[0])}-{letter(value[1])}"
                case c.CATEGORY if value in NOT:
                    beside.append(f"[^{kinds[NOT[value]]}]")
                case c.CATEGORY if value in kinds:
                    inside += kinds[value]
                case _:
                    raise Untranslatable(f"the class {value}")
        parts = ([f"[{inside}]"] if inside else []) + beside
        if negated:
            return f"[^{inside}]" if not beside else f"(?:(?!{'|'.join(parts)}){EVERY})"
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    def place(self, at, flags: int, word: str) -> str:
        border = f"(?:(?<=[{word}])(?![{word}])|(?<![{word}])(?=[{word}]))"
        lines = flags & re.MULTILINE
        told = {
            c.AT_BEGINNING: r"(?:\A|(?<=\n))" if lines else r"\A", c.AT_BEGINNING_STRING: r"\A", c.AT_END: r"(?=\n|\z)" if lines else r"(?=\n?\z)", c.AT_END_STRING: r"\z",
            c.AT_BOUNDARY: border, c.AT_NON_BOUNDARY: f"(?!{border})" + NO_EMPTY,
        }
        if at not in told:
            raise Untranslatable(f"the place {at}")
        return told[at]

    def group(self, number, add: int, drop: int, body, flags: int) -> str:
        inner = (flags | add) & ~drop
        if add & (re.ASCII | re.UNICODE):
            inner = inner & ~(re.ASCII | re.UNICODE) | add & (re.ASCII | re.UNICODE)
        if number is None:
            case = inner & re.IGNORECASE
            head = "" if case == flags & re.IGNORECASE else "iu" if case else "-iu"
            return f"(?{head}:{self.write(body, inner)})"
        self.made += 1
        mine = self.made
        text = self.write(body, inner)
        self.groups[number] = mine
        if number in self.tested:  # an empty group at the end, which takes part whenever this one does
            self.made += 1
            self.marks = {**self.marks, number: self.made - mine}
            text += "()"
        return f"({text})"


def tested_groups(items) -> set[int]:
    """Groups that a condition of the pattern asks for."""
    found: set[int] = set()
    for op, value in items:
        if op is c.GROUPREF_EXISTS:
            found.add(value[0])
        for part in value if isinstance(value, tuple | list) else [value]:
            for sub in part if isinstance(part, list) else [part]:
                if isinstance(sub, _parser.SubPattern):
                    found |= tested_groups(sub)
    return found


@lru_cache(maxsize=4096)
def to_java(pattern: str) -> JavaPattern:
    """A Python pattern in Java's syntax; ``re.error`` if it isn't one, ``Untranslatable`` if Java has no way to say it."""
    with warnings.catch_warnings():  # Python warns of what other languages read as sets of sets
        warnings.simplefilter("ignore", FutureWarning)
        re.compile(pattern)
        read = _parser.parse(pattern)
    flags = read.state.flags
    if flags & re.LOCALE:
        raise Untranslatable("the flag L")
    writer = Writer(tested_groups(read))
    text = writer.write(read, flags)
    names = {n: writer.groups[g] for n, g in read.state.groupdict.items() if g in writer.groups}
    return JavaPattern(f"(?iu:{text})" if flags & re.IGNORECASE else text, dict(writer.groups), names)
