"""License scans by template markup.

A template is license text with regions in SPDX markup: optional wording between
``<<beginOptional>>`` and ``<<endOptional>>``, replaceable wording as
``<<var;name="..";original="..";match="..">>``. It is compiled to an automaton
over words: mandatory words must follow one another exactly, optional ones may be
left out as a whole, a replaceable region takes any words within its bounds
(``.+`` one or more, ``.*`` any number, ``.{m,n}`` that many, ``[^\\n]+`` one or more of one
line and sentence, as in notices). The states
that can be reached together become one state when first met, so a text is read
with one step per word. An automaton starts wherever a text has its first
mandatory word and takes the longest match. Starts that reach the same state go on
as one, so work follows the length of a text however often it starts.

``WHOLE`` has bodies of licenses with every clause and disclaimer, ``TEMPLATES``
notices as authors put them and, in ``OPENINGS``, first sentences of bodies: these
alone say nothing about the conditions behind them.

Words are those of letters, digits and characters beyond ASCII, A-Z lower-cased;
case, punctuation and line breaks of a license do not matter, but for where a
``[^\\n]+`` region must end: at a line break, or at a full stop, exclamation or question
mark with white space and a capital behind it and a word of four characters or more
before it (so not after ``Inc.`` or an initial).

Defined results: a NULL or empty text has no words, no places and score 0; ids
are carried through; repeated rows get equal results; matches that overlap all
count; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from reviewloom.llm.common import alnum_words, as_bytes, columns, keyed_schema, map_batches
from reviewloom.llm.license_texts import WHOLE

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

_VERSION = '<<var;name="version";original="";match=".{0,3}">>'
_HOLDER = r'<<var;name="holder";original="the copyright holder";match="[^\n]+">>'
# Labels and templates: notices as authors put them, and openings of full texts.
TEMPLATES = [
    ("cc-by-4.0", "licensed under cc by 4.0"),
    ("cc-by-4.0", "licensed under <<beginOptional>>a <<endOptional>>creative commons attribution "
     "4.0 <<beginOptional>>international <<endOptional>>license"),
    ("cc-by-nc-4.0", "licensed under cc by-nc 4.0"),
    ("cc-by-sa-4.0", "licensed under cc by-sa 4.0"),
    ("cc0-1.0", "licensed under cc0 1.0"),
    ("mit", "<<beginOptional>>this work is <<endOptional>>released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of "
     "<<var;name=\"thing\";original=\"this software\";match=\".+\">> and associated "
     "documentation files <<beginOptional>>(the \"Software\")<<endOptional>>, to deal in the "
     "<<var;name=\"thing\";original=\"Software\";match=\".+\">> without restriction"),
    ("apache-2.0", "licensed under the apache license, version 2.0"
     "<<beginOptional>> (the \"License\")<<endOptional>>"),
    ("gpl-2.0", "licensed under the gnu general public license, version 2"),
    ("gpl-3.0", "<<beginOptional>>this work is <<endOptional>>licensed under the gnu general "
     "public license, version 3"),
    ("gpl-notice", "under the terms of the gnu general public license as published by the free "
     f"software foundation<<beginOptional>>; either version {_VERSION}<<endOptional>>"),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met"),
    ("copyright", f"copyright <<beginOptional>>(c) <<endOptional>>"
     f"<<var;name=\"year\";original=\"2024\";match=\".{{1,2}}\">> {_HOLDER} all rights reserved"),
]

# Templates above that stop before the conditions.
OPENINGS = {t for _, t in TEMPLATES if t.startswith(("permission is", "redistribution and"))}

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_MATCH = re.compile(r'match="(?:\.(\+|\*|\{(\d+),(\d+)\})|(\[\^\\n\]\+))"')
_ANY = None  # a transition that takes any word
_SAME = b"\n"  # one that takes any word with no border before it
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_STOP = re.compile(rb"[.!?]\S*\s")


@dataclass
class Automaton:
    """States are numbers; 0 starts. ``steps[s]`` has (word, ``_ANY`` or ``_SAME``, target)."""

    label: str
    steps: list[list[tuple[bytes | None, int]]] = field(default_factory=lambda: [[]])
    skips: list[list[int]] = field(default_factory=lambda: [[]])
    final: int = 0

    def state(self) -> int:
        self.steps.append([])
        self.skips.append([])
        return len(self.steps) - 1

    def closed(self, states: Iterable[int]) -> frozenset[int]:
        """With all states reached by leaving out regions."""
        found, waiting = set(), list(states)
        while waiting:
            state = waiting.pop()
            if state not in found:
                found.add(state)
                waiting.extend(self.skips[state])
        return frozenset(found)


def compile_template(label: str, template: str) -> Automaton:
    automaton = Automaton(label)
    at, opened, position = 0, [], 0

    def literal(text: str, at: int) -> int:
        for word in alnum_words(text.encode()):
            after = automaton.state()
            automaton.steps[at].append((word, after))
            at = after
        return at

    for mark in _MARKUP.finditer(template):
        at = literal(template[position : mark.start()], at)
        position = mark.end()
        kind = mark.group(1)
        if kind == "beginOptional":
            # A state of its own, so that leaving out skips this region alone.
            begin = automaton.state()
            automaton.skips[at].append(begin)
            opened.append(begin)
            at = begin
        elif kind == "endOptional":
            end = automaton.state()
            automaton.skips[at].append(end)
            automaton.skips[opened.pop()].append(end)
            at = end
        else:
            bounds = _MATCH.search(kind)
            if not bounds:
                raise ValueError(f"{label}: a replaceable region needs match=\".+\", \".*\", "
                                 f"\".{{m,n}}\" or \"[^\\n]+\", not {kind!r}")
            one_line = bounds.group(4) is not None
            if one_line or bounds.group(1) in "+*":
                if bounds.group(1) != "*":
                    after = automaton.state()
                    automaton.steps[at].append((_ANY, after))
                    at = after
                loop = automaton.state()
                automaton.skips[at].append(loop)
                automaton.steps[loop].append((_SAME if one_line else _ANY, loop))
                at = loop
                continue
            least, most = int(bounds.group(2)), int(bounds.group(3))
            ends = [at] if least == 0 else []
            for taken in range(1, most + 1):
                after = automaton.state()
                automaton.steps[at].append((_ANY, after))
                at = after
                if taken >= least:
                    ends.append(at)
            end = automaton.state()
            for state in ends:
                automaton.skips[state].append(end)
            at = end
    if opened:
        raise ValueError(f"{label}: an optional region is not closed")
    automaton.final = literal(template[position:], at)
    return automaton


class Matcher:
    """Runs an automaton; sets of states met are remembered as states of their own."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.start = automaton.closed([0])
        if automaton.final in self.start:
            raise ValueError(f"{automaton.label}: nothing is mandatory")
        if any(word in (_ANY, _SAME) for s in self.start for word, _ in automaton.steps[s]):
            raise ValueError(f"{automaton.label}: starts with a replaceable region")
        self.first = {word for s in self.start for word, _ in automaton.steps[s]}
        self.words = {word for steps in automaton.steps for word, _ in steps}
        self.by_line = _SAME in self.words
        self.known: dict[tuple[frozenset[int], bytes | None, bool], frozenset[int]] = {}

    def _step(self, states: frozenset[int], word: bytes, border: bool) -> frozenset[int]:
        word = word if word in self.words else _ANY  # all foreign words are alike
        found = self.known.get((states, word, border))
        if found is None:
            taken = {word, _ANY} if border else {word, _ANY, _SAME}
            targets = [t for s in states for w, t in self.automaton.steps[s] if w in taken]
            found = self.known[states, word, border] = self.automaton.closed(targets)
        return found

    def longest(self, words: list[bytes], start: int) -> int:
        """Words of the longest match that begins at ``start``; 0 if there is none."""
        states, longest = self.start, 0
        for at in range(start, len(words)):
            states = self._step(states, words[at], False)
            if not states:
                break
            if self.automaton.final in states:
                longest = at + 1 - start
        return longest

    def spans(
        self, words: list[bytes], starts: list[int], borders: list[bool] | None = None
    ) -> list[tuple[int, int]]:
        """``start, longest`` of all starts, in order, that have a match.

        ``borders``: whether a line or sentence ends before a word.
        """
        final, n = self.automaton.final, len(words)
        ends: list[int] = []  # per run its last end, and the run that it went on in
        onto: list[int] = []
        running: dict[frozenset[int], int] = {}

        def run() -> int:
            ends.append(0)
            onto.append(-1)
            return len(ends) - 1

        own, at, waiting = [], 0, 0
        while waiting < len(starts) or running:
            if not running:
                at = starts[waiting]
            if waiting < len(starts) and starts[waiting] == at:
                own.append(run())
                waiting += 1
                if self.start in running:
                    joined = run()
                    onto[running[self.start]] = onto[own[-1]] = joined
                    running[self.start] = joined
                else:
                    running[self.start] = own[-1]
            if at == n:
                break
            after: dict[frozenset[int], int] = {}
            border = borders is not None and borders[at]
            for states, number in running.items():
                states = self._step(states, words[at], border)
                if not states:
                    continue
                if states in after:
                    joined = run()
                    onto[after[states]] = onto[number] = joined
                    number = joined
                after[states] = number
            at += 1
            for states, number in after.items():
                if final in states:
                    ends[number] = at
            running = after
        for number in reversed(range(len(ends))):  # a run goes on in a later one
            if onto[number] >= 0:
                ends[number] = max(ends[number], ends[onto[number]])
        return [(s, ends[o] - s) for s, o in zip(starts, own) if ends[o]]


def word_borders(text: bytes) -> list[bool]:
    """Per word whether a line or sentence ends between it and the word before."""
    found, before, end = [], b"", 0
    for word in _WORD.finditer(text):
        gap = text[end : word.start()]
        stop = len(before) > 3 and word[0][:1].isupper() and _STOP.search(gap)
        found.append(b"\n" in gap or bool(stop))
        before, end = word[0], word.end()
    return found


class Scanner:
    """All phrases and templates over one text."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.matchers: list[tuple[Matcher, bool]] = []
        self.templates: dict[bytes, list[int]] = {}
        for label, template in templates:
            matcher = Matcher(compile_template(label, template))
            number = len(self.matchers)
            self.matchers.append((matcher, template in OPENINGS))
            for word in matcher.first:
                self.templates.setdefault(word, []).append(number)
        self.phrases: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in phrases.items():
            words = alnum_words(phrase.encode())
            self.phrases.setdefault(words[0], []).append((words, label))
        self.first = {*self.templates, *self.phrases}

    def scan(self, text: bytes | None) -> tuple:
        """n_words, places (start, label) of phrases, spans (label, start, words)."""
        n_words, places, found = self.find(text)
        return n_words, places, [span[:3] for span in found]

    def find(self, text: bytes | None) -> tuple:
        """As ``scan``, with spans (label, start, words, opening)."""
        words = alnum_words(text)
        first = self.first
        places, starts = [], {}
        for at in [i for i, word in enumerate(words) if word in first]:
            for phrase, label in self.phrases.get(words[at], ()):
                if words[at : at + len(phrase)] == phrase:
                    places.append((at, label))
            for number in self.templates.get(words[at], ()):
                starts.setdefault(number, []).append(at)
        longest: dict[tuple, int] = {}  # two templates of a label give one span
        borders = None
        for number, places_of in starts.items():
            matcher, opening = self.matchers[number]
            if matcher.by_line and borders is None:
                borders = word_borders(text)
            for at, length in matcher.spans(words, places_of, borders):
                key = matcher.automaton.label, at, opening
                longest[key] = max(length, longest.get(key, 0))
        spans = [(label, at, n, opening) for (label, at, opening), n in longest.items()]
        return len(words), places, sorted(spans, key=lambda span: (span[1], span[0], span[2]))


SCANNED = """n_words bigint, places array<struct<start: bigint, label: string>>,
  spans array<struct<label: string, start: bigint, n_words: bigint, opening: boolean>>"""


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES + WHOLE,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """Per document: number of words, places of phrases and spans of accepted templates."""
    docs = as_bytes(columns(docs, doc_id=id_col, text=text_col), "text")
    schema = keyed_schema(docs, SCANNED)
    Scanner(templates, phrases)  # a bad template fails here, not in a task

    def make():
        scanner = Scanner(templates, phrases)
        place = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
        span = pa.list_(
            pa.struct([("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()),
                       ("opening", pa.bool_())])
        )

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [scanner.find(t.as_py()) for t in batch.column(1)]
            arrays = [
                batch.column(0),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([[{"start": s, "label": x} for s, x in f[1]] for f in found], place),
                pa.array([[{"label": x, "start": s, "n_words": n, "opening": o}
                           for x, s, n, o in f[2]] for f in found], span),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "places", "spans"])

        return step

    return map_batches(docs, schema, make)
