"""Romanisation: tone marks of one system into the spelling of another.

Three stages, each an ordered list of substitutions over the whole text: marks to tone digits,
digits of system A to digits of system B, digits to marks. The lists are generated from the few
parameters below. Order is part of the meaning: longer spellings go first.

Links, addresses, escaped passages and syllables already in the target spelling are set aside
first, each as one private-use character, which no rule matches and which ends a word.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import normalize

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tonehive.tables import limit_batches

# Combining marks of the tones that are written with one.
ACUTE, GRAVE, CIRCUMFLEX, CARON, MACRON, LINE, DOUBLE_ACUTE, BREVE = "\u0301", "\u0300", "\u0302", "\u030c", "\u0304", "\u030d", "\u030b", "\u0306"
DOT, NASAL = "\u0358", "\u207f"
SOURCE_MARKS = {2: ACUTE, 3: GRAVE, 5: CIRCUMFLEX, 6: CARON, 7: MACRON, 8: LINE, 9: DOUBLE_ACUTE}
TARGET_MARKS = {1: "", 2: ACUTE, 3: GRAVE, 5: CIRCUMFLEX, 7: MACRON, 9: BREVE}
LETTERS_AFTER_A_MARK = "[aAeEgGhHiIkKmMnNoOpPtTuU]*"
NASALS = f"(?:N|{NASAL}|nn)"
CODA = f"((?:rm|rng|rn|r|m|ng|n|nnh|nn|{NASAL}|N)?)"
STOP = f"(h{NASALS}?|H{NASALS}?|p|P|t|T|k|K)"
VOWELS = "aeiouAEIOU"
# Spellings of system A and B, in the order in which they are replaced.
SPELLINGS = [("oonn", f"o{DOT}nn"), ("ts", "ch"), ("oo", f"o{DOT}"), ("ua", "oa"), ("ue", "oe"), ("ing", "eng"), ("ik", "ek")]
CAPITAL_SPELLINGS = [("OONN", f"O{DOT}NN"), ("ONN", f"O{DOT}NN"), ("TS", "CH"), ("OO", f"O{DOT}"), ("UA", "OA"), ("UE", "OE"), ("ING", "ENG"), ("IK", "EK"), ("NNH", "HNN")]
INITIALS = "p|P|ph|Ph|m|M|b|B|t|T|th|Th|n|N|l|L|k|K|kh|Kh|ng|Ng|g|G|s|S|h|H"


@dataclass(frozen=True)
class Options:
    """nasal: superscript n for final N too; tone6_caron: caron rather than acute for tone 6; capitals: words in capitals too."""

    nasal: bool = True
    tone6_caron: bool = False
    capitals: bool = True


#: Parts of a pattern that a match may lack: classes, groups, escapes and optional characters.
_OPEN_PARTS = [re.compile(r"\[[^\]]*\][*+?]?"), re.compile(r"\((?:\?:)?[^()]*\)[*+?]?"), re.compile(r"\\.[*+?]?"), re.compile(r".[*?]", re.DOTALL)]


@dataclass(frozen=True)
class Rule:
    """A substitution; `before_edge` asks for the end of a word after the match.

    Without the characters `idle_without` in a text the rule changes nothing.
    """

    pattern: str
    to: str
    before_edge: bool = False
    idle_without: str = ""

    def compiled(self) -> tuple[re.Pattern, str]:
        return re.compile(self.pattern + (r"\b" if self.before_edge else "")), re.sub(r"\\(\d)", r"\\g<\1>", self.to)

    @property
    def literal(self) -> bool:
        """Whether pattern and replacement are plain characters."""
        return not self.before_edge and re.escape(self.pattern) == self.pattern and "\\" not in self.to

    @property
    def needed(self) -> str:
        """Characters that a text must hold for the rule to change it: a digit or mark if there is one."""
        if self.idle_without:
            return self.idle_without
        rest = self.pattern
        for part in _OPEN_PARTS:
            while (fewer := part.sub("\0", rest)) != rest:
                rest = fewer
        return max(rest.split("\0"), key=lambda x: (any(c.isdigit() for c in x), not x.isascii(), len(x)))


def _with(letter: str, mark: str) -> str:
    return normalize("NFC", letter + mark)


def _both(letters: str) -> list[str]:
    """Lower case, then with the first letter upper."""
    return [letters, letters[0].upper() + letters[1:]]


def marks_to_digits() -> list[Rule]:
    rules = []
    for vowel in ("a", "e", "i", "oo", "o", "u", "m", "n"):
        for tone, mark in SOURCE_MARKS.items():
            for spelled in _both(vowel):
                shown = _with(spelled[0], mark) + (DOT if vowel == "oo" else "")
                rules.append(Rule(f"{shown}({LETTERS_AFTER_A_MARK})", rf"{spelled}\1{tone}"))
    return [*rules, Rule(f"o{DOT}", "oo"), Rule(f"O{DOT}", "Oo"), Rule(NASAL, "nn")]


def a_to_b(options: Options, keep_1_4: bool = False) -> list[Rule]:
    rules = []
    if not keep_1_4:
        rules.append(Rule(rf"([{VOWELS}](?:nn|ng|[Nnm])?|(?:{INITIALS})?(?:[nN]g|[mM]))1", r"\1"))
        rules.append(Rule(rf"([{VOWELS}](?:(?:nn|N)?[hH]|[pPtTkK])|(?:[mM]|[nN]g)[hH])4", r"\1"))
    for old, new in SPELLINGS:
        rules += [Rule(x, y) for x, y in zip(_both(old), _both(new), strict=True)]
    rules.append(Rule("nnh", "hnn"))
    return rules + [Rule(x, y) for x, y in CAPITAL_SPELLINGS if options.capitals]


def _nasal_rules(options: Options) -> list[Rule]:
    after = lambda letters: rf"([{letters}]{DOT}?h?|[hH])"
    small = VOWELS[:5] + "mM"
    rules = [Rule(after(VOWELS + "mM") + r"nn(\d?)", rf"\1{NASAL}\2", True)]
    if options.nasal:
        rules += [Rule(after(small) + r"N(\d?)", rf"\1{NASAL}\2", True), Rule(rf"([{small}]{DOT}?)Nh?(\d?)", rf"\1h{NASAL}\2", True)]
    return rules


def digits_to_marks(options: Options) -> list[Rule]:
    marks = TARGET_MARKS | {6: CARON if options.tone6_caron else ACUTE}
    rules = _nasal_rules(options)
    for tone in range(1, 10):  # a before i or u
        for a in "aA":
            if tone == 4:
                rules.append(Rule(rf"{a}(i|u)({NASALS}?)h4", rf"{a}\1\2h"))
            elif tone == 8:
                rules.append(Rule(rf"{a}(i|u)h{NASALS}8", rf"{a}{LINE}\1h{NASAL}"))
            else:
                rules.append(Rule(rf"{a}(u|i)({NASALS}?){tone}", rf"{_with(a, marks[tone])}\1\2"))
        if tone == 8:
            rules += [Rule(rf"{a}(i|u)h8", rf"{a}{LINE}\1h") for a in "aA"]
    for tone in range(1, 10):  # u before i or u
        for u in "uU":
            if tone in (4, 8):
                rules.append(Rule(rf"{u}ih({NASALS}?){tone}", rf"{u}{LINE if tone == 8 else ''}ih\1"))
            else:
                rules.append(Rule(rf"{u}(u|i)({NASALS}?){tone}", rf"{_with(u, marks[tone])}\1\2"))
    rules.append(Rule(rf"(o|O)([ae])({NASALS}?)1?", r"\1\2\3", True, idle_without="1"))
    for tone in (2, 3, 5, 6, 7, 9):  # open oa and oe
        rules += [Rule(rf"{o}([ae])({NASALS}?){tone}", rf"{_with(o, marks[tone])}\1\2", True) for o in "oO"]
    for vowel in ("a", "e", "i", f"o{DOT}", "o", "u"):
        for tone in range(1, 10):
            for v in _both(vowel):
                dot = v[1:]
                if tone == 4:
                    rules.append(Rule(f"{v}{STOP}4?", rf"{v}\1", idle_without="4"))
                elif tone == 8:
                    rules.append(Rule(f"{v}{STOP}8", rf"{v[0]}{LINE}{dot}\1"))
                else:
                    rules.append(Rule(f"{v}{CODA}{tone}", rf"{_with(v[0], marks[tone])}{dot}\1"))
    for cases in (("m", "M"), ("ng", "Ng")):
        for tone in range(1, 10):
            for s in cases:
                h, mark = ("h", {4: "", 8: LINE}[tone]) if tone in (4, 8) else ("", marks[tone])
                rules.append(Rule(f"{s}{h}{tone}", _with(s[0], mark) + s[1:] + h))
    if options.capitals:
        for tone in range(1, 10):
            h, mark = ("H", {4: "", 8: LINE}[tone]) if tone in (4, 8) else ("", ACUTE if tone == 2 else marks[tone])
            rules.append(Rule(f"NG{h}{tone}", _with("N", mark) + "G" + h))
    return rules


@lru_cache(64)
def _compiled(rules: tuple[Rule, ...]) -> tuple[tuple[re.Pattern, str], ...]:
    return tuple(r.compiled() for r in rules)


def _apply(rules: list[Rule], text: str) -> str:
    for pattern, to in _compiled(tuple(rules)):
        text = pattern.sub(to, text)
    return text


def to_digits(text: str | None, nasal: str = "nn", show_1_4: bool = False) -> str | None:
    """Stage 1. nasal "N" writes N for nn after a vowel; show_1_4 adds the digits of unmarked tones."""
    if not text:
        return text
    text = _apply(marks_to_digits(), text)
    if nasal == "N":
        text = re.sub(f"(?<=[{VOWELS}])nn", "N", text)
    if show_1_4:
        text = re.sub(rf"([{VOWELS}mMn]|[nN]g)\b", r"\g<1>1", text)
        text = re.sub(r"([hHpPtTkK])\b", r"\g<1>4", text)
    return text


def digits_a_to_b(text: str | None, keep_1_4: bool = False, options: Options = Options()) -> str | None:
    """Stage 2."""
    return _apply(a_to_b(options, keep_1_4), text) if text else text


def to_marks(text: str | None, options: Options = Options()) -> str | None:
    """Stage 3."""
    return _apply(digits_to_marks(options), text) if text else text


# What is set aside, in this order, and characters that it cannot lack; the group, if
# there is one, is what is kept of the match.
_LETTER = r"(?:[^\W\d_]|[\u0300-\u036f])"
_SET_ASIDE = [
    ("](", re.compile(r"!\[[^\]]*\]\([^)]+\)")),
    ("](", re.compile(r"\[[^\]]+\]\([^)]+\)")),
    ("://", re.compile(r"(?:https?|ftp)://[^\s)\]\\]+")),
    ("\\[", re.compile(r"\\\[(.*?)(?:\\\]|\Z)", re.DOTALL)),
    (NASAL, re.compile(_LETTER + f"+{NASAL}")),
    (DOT, re.compile(f"{_LETTER}*[oO]{DOT}{_LETTER}*")),
]
_FIRST_PRIVATE = 0xF0000
_TOKEN = re.compile(r"([\w\u0300-\u036f]+)")
_DIGIT = re.compile(r"\d")


#: Characters of the longest token that a memo keeps.
LONGEST = 64


class _Memo(dict):
    """Converted tokens; a new one is converted when it is asked for.

    When `limit` are kept they become the older half, in which tokens are still looked up, and the half
    before them goes; so common tokens stay and memory is bounded by 2 * `limit` tokens of at most
    LONGEST characters, whatever the texts hold. Most rules need a digit, a mark or a spelling that most tokens lack; they are passed over. Digits
    come from the token or from its marks alone.
    """

    def __init__(self, options: Options, limit: int):
        super().__init__()
        chain = [marks_to_digits(), a_to_b(options), digits_to_marks(options)]
        with_stage = [(n, r.needed, *((None, r.to) if r.literal else r.compiled())) for n, stage in enumerate(chain) for r in stage]
        self._rules = [r[1:] for r in with_stage]
        self._plain = [r[1:] for r in with_stage if not any(c.isdigit() for c in r[1]) and (r[0] or r[1].isascii())]
        # A token that holds nothing that a rule needs is not changed by any.
        self._idle_without = [re.compile("|".join(sorted({re.escape(r[0]) for r in rules}))) for rules in (self._plain, self._rules)]
        self._limit = limit
        self._older: dict[str, str] = {}

    def __missing__(self, token: str) -> str:
        got = self._older.get(token)
        if got is None:
            got = self._converted(token)
        if len(token) <= LONGEST:
            if len(self) >= self._limit:
                self._older = dict(self)
                self.clear()
            self[token] = got
        return got

    def _converted(self, token: str) -> str:
        got = token
        plain = token.isascii() and not _DIGIT.search(token)
        if not self._idle_without[0 if plain else 1].search(token):
            return token
        for needed, pattern, to in self._plain if plain else self._rules:
            if needed in got:
                got = got.replace(needed, to) if pattern is None else pattern.sub(to, got)
        return got


class Converter:
    """All stages, token by token: every rule matches within a run of word characters and marks."""

    def __init__(self, options: Options = Options(), memo: int = 150_000):
        self._tokens = _Memo(options, memo)

    def tokens(self, text: str) -> str:
        """The text with every token converted."""
        parts = _TOKEN.split(text)
        parts[1::2] = map(self._tokens.__getitem__, parts[1::2])
        return "".join(parts)

    def __call__(self, text: str | None) -> str | None:
        """Null stays null; what is set aside comes back as it was, also where one holds another."""
        if not text:
            return text
        kept: list[str] = []
        first = 0

        def aside(m: re.Match) -> str:
            kept.append(m[1] if m.re.groups else m[0])
            return chr(first + len(kept) - 1)

        for needed, pattern in _SET_ASIDE:
            if needed in text:
                first = first or max(_FIRST_PRIVATE, 1 + ord(max(text)))
                text = pattern.sub(aside, text)
        text = self.tokens(text)
        for i in range(len(kept) - 1, -1, -1):  # later ones may hold earlier ones
            text = text.replace(chr(first + i), kept[i])
        return text


def convert_text(text: str | None, options: Options = Options()) -> str | None:
    """The whole conversion of one text."""
    return _converter(options)(text)


@lru_cache(8)
def _converter(options: Options) -> Converter:
    return Converter(options)


def _vectorised(options: Options):
    @F.pandas_udf("string")
    def convert(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = _converter(options)
        for texts in batches:
            yield texts.map(lambda t: one(t) if isinstance(t, str) else None)

    return convert


def convert(column: Column | str, options: Options = Options()) -> Column:
    """The whole conversion as a column: Arrow batches of bounded size, rules compiled once a worker."""
    limit_batches(SparkSession.active())
    return _vectorised(options)(column)


#: Rules up to which native stages are nested calls; more would exceed the code limit of a generated class.
NESTED = 40


def native(column: Column, rules: list[Rule]) -> Column:
    """Rules as built-in expressions, so that each pattern is compiled once.

    A longer list is folded over a table of (pattern, replacement) instead, so that the plan stays small; where rules
    ask for marks, only over those whose mark the text holds.
    """
    word_end = r"(?![\p{L}\p{N}_])"
    java = [(r.pattern + (word_end if r.before_edge else ""), re.sub(r"\\(\d)", r"$\1", r.to)) for r in rules]
    if len(rules) <= NESTED:
        for r, (pattern, to) in zip(rules, java, strict=True):
            column = F.replace(column, F.lit(pattern), F.lit(to)) if r.literal else F.regexp_replace(column, pattern, to)
        return column
    pairs = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(t).alias("t"), F.lit(_rarest(r)).alias("c")) for r, (p, t) in zip(rules, java, strict=True)))
    fold = lambda text, chosen: F.aggregate(chosen, text, lambda acc, r: F.regexp_replace(acc, r["p"], r["t"]))
    if not all(_rarest(r) and r.to.isascii() for r in rules):
        return fold(column, pairs)
    # Each asks for a character beyond ASCII and none makes one, so what a text holds at first says which can match.
    some = lambda text, held: F.when(held == "", text).otherwise(fold(text, F.filter(pairs, lambda r: F.contains(held, r["c"]))))
    return _bound(column, lambda text: _bound(F.regexp_replace(text, r"[\x00-\x7f]+", ""), lambda held: some(text, held)))


def _rarest(rule: Rule) -> str:
    """The last character beyond ASCII that a text must hold for the rule to match; empty if there is none."""
    return "".join(c for c in rule.needed if not c.isascii())[-1:]


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often `then` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def sql(column: str, rules: list[Rule]) -> str:
    """The same as nested regexp_replace calls for an engine without look-around."""
    out = column
    for r in rules:
        pattern, to = r.pattern, r.to
        if r.before_edge:
            groups = re.compile(pattern).groups + 1
            pattern, to = pattern + r"([^\p{L}\p{N}_]|$)", f"{to}\\{groups}"
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return out


def register(spark: SparkSession, name: str = "convert_roman") -> None:
    """Makes the conversion a SQL function."""
    limit_batches(spark)
    spark.udf.register(name, _vectorised(Options()))
