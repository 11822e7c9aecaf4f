"""Personal data in texts, plain and disguised, with spans in the source.

Four kinds are found: ``email``, ``ip``, ``card``, ``phone``. Plain ones are matched in the text
as it is. For disguised ones the text goes through transducers, each a list of edits that
remembers which source characters an output character stands for: look-alike letters and digits
to ASCII and invisible characters to nothing, spelled digits to digits, ``at`` and ``dot`` in
words or brackets to ``@`` and ``.``. A bare ``at`` after a pronoun or a verb of place is prose (``meet me at noon``);
``arroba`` and ``arobase`` never are, so the words for a dot of their languages count after them. A run of spelled digits may be read in several ways, as what
stands beside it may belong to it or not: each reading is looked through, also that without digits.
What the same detectors find in an outcome is mapped back
to the source and added unless a span of the kind covers it wholly. A row of digits that is too long for
a card is looked through once more for cards that stand in it as words of their own.

Offsets are code points, ends exclusive. Null text counts as empty and has no spans. Texts are
taken whole; all detectors take time in proportion to the text. Rows are independent, so
repeated rows, ties and empty tables need nothing special. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame

from driverlens.llm.common import with_columns

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]+)?")  # any row of digits, so that none is looked at twice
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_WORD = re.compile(r"(?<![0-9-])(?:[0-9]{16,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9-])")

# Letters that look like ASCII ones, and characters without a shape.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ѕ": "S",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "﹒": ".", "。": ".", "﹫": "@",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "plus": "+", "dot": ".", "point": ".", "punkt": ".", "punto": ".",
}
STARTS = frozenset(DIGIT_WORDS)  # a run has one of these at its start or after its first figure
LETTERS = re.compile(r"[^\W\d_]+")

# Words before a bare "at" that are no local part.
PROSE = frozenset((
    "i", "me", "you", "he", "him", "she", "her", "it", "us", "we", "they", "them", "this", "that", "these", "those", "one", "all", "both", "everyone", "here", "there",
    "am", "is", "are", "was", "were", "be", "been", "being", "look", "looks", "looked", "looking", "meet", "meets", "met", "meeting", "arrive", "arrives", "arrived", "arriving",
    "stay", "stays", "stayed", "start", "starts", "started", "starting", "stop", "stops", "stopped", "end", "ends", "ended", "begin", "begins", "began", "open", "opens", "opened",
    "close", "closes", "closed", "work", "works", "worked", "working", "sit", "sits", "sat", "stand", "stands", "stood", "live", "lives", "lived", "leave", "leaves", "left",
    "and", "or", "but", "not", "only", "just", "even", "still", "again", "now", "then", "later", "today", "tomorrow", "tonight", "at",
))


def _shapes() -> dict[int, str]:
    """Look-alikes, ASCII in other shapes (full-width, styled, circled; not raised or lowered, as these mark
    footnotes) and the decimal digits of all scripts."""
    table = {code: chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}
    for code in range(128, 0x20000):
        shape, *plain = unicodedata.decomposition(chr(code)).split() or [""]
        if shape in ("<font>", "<circle>", "<wide>", "<narrow>") and len(plain) == 1 and int(plain[0], 16) < 128:
            table[code] = chr(int(plain[0], 16))
    table |= {ord(c): plain for c, plain in LOOK_ALIKES.items()}
    for code in range(128, 0x20000):
        if unicodedata.category(chr(code)) == "Nd":
            table[code] = str(unicodedata.digit(chr(code)))
    return table


def _ranges(codes) -> str:
    """A regex class body of single code points and runs."""
    runs: list[list[int]] = []
    for code in sorted(codes):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" if a != b else re.escape(chr(a)) for a, b in runs)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str):
    """Leftmost addresses: around each ``@`` with a domain, the longest free local part."""
    done = 0
    for found in DOMAIN.finditer(text):
        at = start = found.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            done = found.end()
            yield start, done


def ips(text: str):
    for found in IP.finditer(text):
        if found[1] and all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in found.group().split(".")):
            yield found.span()


def cards(text: str):
    for found in CARD.finditer(text):
        if 16 <= len(digits := _digits(found.group())) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str):
    for found in PHONE.finditer(text):
        if 8 <= len(_digits(found.group())) <= 15:
            yield found.span()


def plain(text: str) -> list[tuple[str, int, int]]:
    """Spans in a text as it is, by kind and start."""
    found = [("email", *span) for span in emails(text)] if "@" in text else []
    found += [("ip", *span) for span in ips(text)]
    found += [("card", *span) for span in cards(text)]
    return found + ([("phone", *span) for span in phones(text)] if "+" in text else [])


class Edited:
    """A text after non-overlapping edits (start, end, output), with the way back."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        self.starts, self.edits, parts, done, size = [], edits, [], 0, 0
        for start, end, output in edits:
            parts += [text[done:start], output]
            size += start - done
            self.starts.append(size)
            size += len(output)
            done = end
        self.text = "".join([*parts, text[done:]])

    def _source(self, at: int) -> tuple[int, int]:
        """The source characters that one output character stands for."""
        i = bisect_right(self.starts, at) - 1
        if i < 0:
            return at, at + 1
        (start, end, output), begin = self.edits[i], self.starts[i]
        if at < begin + len(output):
            return start, end
        at = end + at - begin - len(output)
        return at, at + 1

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._source(start)[0], self._source(end - 1)[1]


class Transducers:
    """The rewriting steps, each a function from a text to its edits."""

    def __init__(self):
        self.shapes = _shapes()
        odd = _ranges([*self.shapes, *map(ord, INVISIBLE)])
        self.odd = re.compile(f"[{odd}]")
        word = "|".join(sorted(map(re.escape, DIGIT_WORDS), key=len, reverse=True))
        self.word = re.compile(rf"\b(?:{word})\b|[0-9]+", re.IGNORECASE)
        following = rf"(?:{word})(?:[ ,\t-]{{1,3}}(?:{word}|[0-9]+))"
        self.spelled = re.compile(rf"\b{following}{{3,}}\b", re.IGNORECASE)
        self.led = re.compile(rf"\b(?:[0-9]++[ ,\t-]{{1,3}}{following}{{2,}}|{following}{{3,}})\b", re.IGNORECASE)
        opened, closed = r"[ \t]{0,3}[\[({<][ \t]{0,3}", r"[ \t]{0,3}[\])}>][ \t]{0,3}"
        dot = rf"(?:{opened}(?:dot|punkt|point|punto){closed}|(?<=[a-z0-9])[ \t]{{1,3}}dot[ \t]{{1,3}}(?=[a-z0-9]))"
        self.at = re.compile(rf"{opened}(?:at|@|arroba){closed}|(?<=[a-z0-9])[ \t]{{1,3}}at[ \t]{{1,3}}(?=[a-z0-9-]{{1,63}}{dot}[a-z])", re.IGNORECASE)
        self.dot = re.compile(dot, re.IGNORECASE)
        # Whole spoken addresses, where the words for a dot mean nothing else.
        blank, label = r"[ \t]{1,3}", r"[a-z0-9-]{1,63}"
        tail = rf"{blank}{label}(?:(?:{blank}(?:%s){blank}|\.){label})+"
        self.spoken = re.compile(rf"(?<=[a-z0-9]){blank}(?:(?:arroba|arobase){tail % 'dot|punto|point|punkt'}|at{tail % 'punto|punkt'})", re.IGNORECASE)
        self.said = re.compile(rf"{blank}(arroba|arobase|at|dot|punto|point|punkt){blank}", re.IGNORECASE)
        self.bracket = re.compile(rf"[\[({{<][ \t]{{0,3}}(?:at|@|arroba|dot|punkt|point|punto)[ \t]{{0,3}}[\])}}>]|[dD][oO][tT]\b|\b(?:arroba|arobase|punkt|punto)\b", re.IGNORECASE)
        # In this order: what an earlier reading finds stays, also beside a longer span of a later one.
        self.readings = (self.loose_digits, self.digits, self.led_digits)

    def shaped(self, text: str):
        if text.isascii():
            return []
        return [(m.start(), m.end(), self.shapes.get(ord(m.group()), "")) for m in self.odd.finditer(text)]

    def digits(self, text: str):
        """Runs from a word on as one."""
        return self._runs(self.spelled, text, "")

    def led_digits(self, text: str):
        """Runs with the figure before them; a comma beside a figure ends a number."""
        return self._runs(self.led, text, ",")

    def loose_digits(self, text: str):
        """Runs with the figure before them; what separates a figure from another or from a spelled digit stays as a blank or comma."""
        return self._runs(self.led, text, " ,\t-")

    def _runs(self, runs: re.Pattern, text: str, apart: str):
        return [edit for run in runs.finditer(text) for edit in self._joined(run.start(), [(m.start(), m.end(), m.group()) for m in self.word.finditer(run.group())], run.group(), apart)]

    def _joined(self, offset: int, words, run: str, apart: str):
        """Each word becomes its digit. What separates it from the next goes; beside a figure a character of ``apart`` leaves a blank, or the comma if there is one."""
        outputs = [DIGIT_WORDS.get(w.lower(), w) for _, _, w in words]
        for i, (start, end, w) in enumerate(words):
            yield offset + start, offset + end, outputs[i]
            if i + 1 < len(words):
                after, _, following = words[i + 1]
                figures = outputs[i].isdigit() and outputs[i + 1].isdigit() and (w.isdigit() or following.isdigit())
                between = run[end:after]
                if not figures or not any(c in apart for c in between):
                    yield offset + end, offset + after, ""
                elif "," not in between:
                    yield offset + end, offset + after, " "

    def marks(self, text: str):
        if not self.bracket.search(text):
            return []
        edits = [(m.start(), m.end(), "@") for m in self.at.finditer(text) if not (m.group().strip().isalpha() and self._prose(text, m.start()))]
        edits += [(m.start(), m.end(), ".") for m in self.dot.finditer(text)]
        for m in self.spoken.finditer(text):
            if not self._prose(text, m.start()):
                parts = list(self.said.finditer(m.group()))
                edits += [(m.start() + p.start(), m.start() + p.end(), "." if i else "@") for i, p in enumerate(parts)]
        kept, done = [], 0
        for edit in sorted(edits):
            if edit[0] >= done:
                kept.append(edit)
                done = edit[1]
        return kept

    def _prose(self, text: str, end: int) -> bool:
        """Whether the word before a bare ``at`` is one of prose."""
        start = end
        while start and end - start < 12 and text[start - 1] in LOCAL:
            start -= 1
        return text[start:end].lower() in PROSE

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Plain spans, and the spans that only normalising shows, both by kind and start."""
        base = plain(text)
        shaped = [Edited(text, edits)] if (edits := self.shaped(text)) else []
        here = shaped[0].text if shaped else text
        read = [[]]  # the edits of each reading, the first without digits
        if not STARTS.isdisjoint(LETTERS.findall(here.lower())):
            read += filter(None, (reading(here) for reading in self.readings))
        added: list[tuple[str, int, int]] = []
        seen = set()
        for digits in read:
            layers = [*shaped, Edited(here, digits)] if digits else list(shaped)
            told = layers[-1].text if layers else text
            if told in seen:
                continue
            seen.add(told)
            if edits := self.marks(told):
                layers.append(Edited(told, edits))
            mapped = self._mapped(text, layers[-1].text if layers else text, layers)
            added += [span for kind in KINDS for span in _uncovered(kind, base + added, mapped)]
        return base, sorted(added, key=lambda s: (KINDS.index(s[0]), *s[1:]))

    def _mapped(self, text: str, here: str, layers: list[Edited]) -> list[tuple[str, int, int]]:
        """What is found in an outcome, in places of the source."""
        found = plain(here) if layers else []
        found += [("card", *m.span()) for run in CARD.finditer(here) if len(run.group()) > 19 for m in CARD_WORD.finditer(here, *run.span()) if luhn(_digits(m.group()))]
        mapped = []
        for kind, start, end in found:
            for layer in reversed(layers):
                start, end = layer.back(start, end)
            mapped.append((kind, start, _trimmed(text, start, end)))
        return mapped


def _trimmed(text: str, start: int, end: int) -> int:
    """The end without white space that an edit took along."""
    while end > start and text[end - 1].isspace():
        end -= 1
    return end


def _uncovered(kind: str, base: list[tuple[str, int, int]], mapped: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The mapped spans of a kind that no plain or longer mapped span of it covers, by start."""
    known = sorted((start, -end, plain) for spans, plain in ((base, 0), (mapped, 1)) for k, start, end in spans if k == kind)
    out, reach = [], -1
    for start, end, added in known:
        if -end > reach:
            reach = -end
            if added:
                out.append((kind, start, reach))
    return out


def find(docs: DataFrame, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``base_spans`` and ``added_spans``: arrays of (kind, start, end), by kind and start."""

    def make():
        found = Transducers()
        return lambda value: found.spans(value or "")

    span = "ARRAY<STRUCT<kind: STRING, start: BIGINT, end: BIGINT>>"
    return with_columns(docs, [text], f"base_spans {span}, added_spans {span}", make, drop)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping ones, replaced by its first kind's name."""
    parts, done = [], 0
    for start, end, kind in sorted((start, -end, kind) for kind, start, end in spans):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, -end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same columns with every span of the text masked; null stays null."""

    def make():
        found = Transducers()

        def row(value):
            if value is None:
                return (None,)
            base, added = found.spans(value)
            return (redacted(value, base + added) if base or added else value,)

        return row

    return with_columns(docs, [text], f"`{text}` STRING", make).select(*docs.columns)
