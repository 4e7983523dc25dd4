"""Secret scan that reads assignments: names, literals, constants passed on, and how telling the name is.

Fixed patterns find what has a known shape. The lexer finds the rest: it reads
``name = literal`` pairs as they stand in source code and configuration (also
``name: literal``, ``"name": literal`` and ``name => literal``), on the same line
or behind line breaks, comments and opening brackets, joins literals that are
added up, follows names that stand for earlier literals of the text, and scores
each literal by the name it ends up in. Bare literals need a digit; on a later
line than their name they must stand alone. Quoted ones may have any length and,
in threefold marks, line breaks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column

# The base patterns and the fewest characters that count.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "lexed")

WORDS_BEFORE_ASSIGN = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Parts of a name and what each adds to its score; a name's parts are split at punctuation and case changes.
NAME_SCORES = {
    "password": 4, "passwd": 4, "pwd": 4, "passphrase": 4, "secret": 4, "credential": 4, "credentials": 4, "apikey": 4,
    "token": 3, "bearer": 3, "private": 2, "access": 2, "auth": 2, "authorization": 2, "signing": 2, "encryption": 2,
    "session": 1, "client": 1, "api": 2, "key": 2, "pass": 3, "pin": 1, "salt": 2, "webhook": 1,
}
#: Literals that stand for a secret but are none.
PLACEHOLDERS = re.compile(r"(?i)\A(?:x+|\*+|\.+|<.*>|\$\{?.*\}?|%.*%|none|null|true|false|changeme|example|your[_-].*|todo|redacted)\Z")
LEAST_NAME, LEAST_TOTAL, LEAST_LITERAL = 3, 6.0, 6
#: What a quoted literal loses without a digit, and for its share of white space.
NO_DIGIT, SPACES = 1.0, 20.0

#: What stands between a name and its literal.
OP = re.compile(r":=|=>|(?<![=!<>:])=(?!=)|(?<!:):(?![:=])")
NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.\-]*+")
NAME_BACKWARDS = re.compile(r"[A-Za-z0-9_$.\-]+")
#: Behind the mark a literal may come after line breaks, comments and opening brackets; YAML marks a block with | or >.
COMMENT = re.compile(r"(?<=\s)(?:#|//(?=\s))[^\n]*+(?:\n|\Z)")
GAP = re.compile(rf"(?:\s|\\\n|[(\[{{]|{COMMENT.pattern}|[|>][+-]?[0-9]?(?=[ \t]*\n))*+")
WITHIN = re.compile(r"[ \t(\[{]*+")
OPENED = re.compile(r"""(?:[A-Za-z@]{1,2}(?=["']))?("{3}|'{3}|"|')""")
BODIES = {'"': re.compile(r'(?:[^"\\\n]++|\\[^\n])*+'), "'": re.compile(r"(?:[^'\\\n]++|\\[^\n])*+"),
          '"' * 3: re.compile(r'(?:[^"\\]++|\\[\s\S]|"(?!""))*+'), "'" * 3: re.compile(r"(?:[^'\\]++|\\[\s\S]|'(?!''))*+")}
BARE = re.compile(r"[A-Za-z0-9+/_.=\-]++")
DIGIT = re.compile(r"[0-9]")
#: A plus sign that a further part follows, on a new line only if that part is quoted; quoted parts in brackets need none.
JOIN = re.compile(r"""[ \t]*(?:\\\n[ \t]*)?\+(?![+=])\s*(?=["'A-Za-z_$0-9])|\s*\+\s*(?=["'])""")
BESIDE = re.compile(r"""(?:\s|\\\n)*+(?=["'])""")
COMMA = re.compile(rf"\s*,(?:\s|{COMMENT.pattern})*+")
#: Behind a value: it is the name of a further assignment. At a bare value on a later line: likewise, and what may follow such a value.
KEY = re.compile(r"[ \t]*(?::(?!:)|=>|=(?!=))")
HEAD = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.\-]*=+[^=\s]")
ALONE = re.compile(r"[ \t\r]*[)\]},;]*[ \t\r]*(?:(?:#|//)[^\n]*)?(?:\n|\Z)")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> int:
    return sum(NAME_SCORES.get(p.lower(), 0) for p in set(PART.findall(name)))


def literal_score(value: str) -> float:
    """Bits of entropy a character, and a point for each further class of characters."""
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return entropy + classes - 1


@dataclass(frozen=True)
class Literal:
    """Places of the different texts it is joined from, its length, the places to report, and whether a part is quoted.

    Parts that stand side by side are one place to report; those of a name stay where they are.
    """

    pieces: tuple[tuple[int, int], ...]
    length: int
    spans: tuple[tuple[int, int], ...]
    quoted: bool


class Reader:
    """Reads the assignments of one text; ``constants`` holds the literals that names stand for so far."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.constants: dict[str, Literal] = {}
        self.unclosed: dict[str, int] = {}  # up to where a quotation mark is known to have no partner
        self.run = (0, 0, -1)  # the last run of bare characters, and its last digit

    def name_before(self, floor: int, at: int) -> str:
        part = self.text[floor:at]
        name = part.rstrip()
        if "\n" in part[len(name):]:
            return ""
        if name[-1:] in ('"', "'"):
            mark = name[-1]
            name = name[:-1]
            if (j := name.rfind(mark)) >= 0 and "\n" not in name[j:]:
                return name[j + 1:]
        m = NAME_BACKWARDS.match(name[::-1])
        return m[0][::-1].lstrip("0123456789.-") if m else ""

    def quoted(self, at: int) -> tuple[int, int, int] | None:
        """Start and end of what is quoted at ``at``, and where the quotation ends."""
        m = OPENED.match(self.text, at)
        for mark in dict.fromkeys((m[1], m[1][0])) if m else ():
            start = m.start(1) + len(mark)
            if start > self.unclosed.get(mark, -1):
                end = BODIES[mark].match(self.text, start).end()
                if self.text.startswith(mark, end):
                    return start, end, end + len(mark)
                self.unclosed[mark] = end
        return None

    def bare(self, at: int) -> tuple[int, bool]:
        """End of the bare characters at ``at``, and whether there is a digit among them."""
        if not self.run[0] <= at < self.run[1]:
            m = BARE.match(self.text, at)
            if not m:
                return at, False
            self.run = at, m.end(), max((d.start() for d in DIGIT.finditer(self.text, at, m.end())), default=-1)
        end = self.run[1]
        if end - at > 1 and self.text[end - 1] == "+" and JOIN.match(self.text, end - 1):
            end -= 1
        return end, at <= self.run[2]

    def literal(self, at: int, opened: bool) -> tuple[Literal, int]:
        """The literal at ``at``, without pieces if there is none, and where it ends."""
        pieces: list[tuple[int, int]] = []
        spans: list[tuple[int, int]] = []
        length, beside, quoted, end = 0, False, False, at
        while True:
            n = NAME.match(self.text, at)
            if q := self.quoted(at):
                a, b, end = q
                quoted, counts = True, b > a
            elif n and n[0] in self.constants and self.text[n.end():n.end() + 1] not in ("/", "="):
                known, end, counts = self.constants[n[0]], n.end(), False
                pieces += known.pieces
                spans += known.spans
                length += known.length
                quoted |= known.quoted
                beside = False
            else:
                a, (b, counts) = at, self.bare(at)
                if a == b:
                    break
                end, beside = b, beside and counts
            if counts:
                pieces.append((a, b))
                spans.append((spans.pop()[0] if beside else a, b))
                length += b - a
                beside = True
            follows = JOIN.match(self.text, end) or (BESIDE.match(self.text, end) if opened and q else None)
            if not follows:
                break
            at = follows.end()
        return Literal(tuple(dict.fromkeys(pieces)), length, tuple(dict.fromkeys(spans)), quoted), end

    def pairs(self) -> Iterable[tuple[str, Literal]]:
        """Name and literal of each assignment; a list gives a pair for each of its literals."""
        text, at, floor, passed = self.text, 0, 0, 0
        while m := OP.search(text, at):
            name = self.name_before(floor, m.start())
            at = floor = m.end()
            if not name:
                continue
            here = (GAP if at >= passed else WITHIN).match(text, at).end()  # one in a comment that was passed over stays in it
            passed = max(passed, here)
            gap = COMMENT.sub("\n", text[at - 1:here])[1:]
            opened, later = any(c in gap for c in "([{"), "\n" in gap
            found: list[Literal] = []
            while True:
                value, end = self.literal(here, opened)
                if end == here or (opened or later) and KEY.match(text, end):
                    break
                if later and not opened and not value.quoted and (HEAD.match(text, here) or not ALONE.match(text, end)):
                    break
                if value.pieces:
                    found.append(value)
                if value.quoted or value.pieces and name_score(name) >= LEAST_NAME:
                    at = floor = end  # else the value may hold an assignment of its own
                comma = COMMA.match(text, end) if opened else None
                if not comma:
                    break
                here = comma.end()
            if len(found) == 1:
                self.constants[name] = found[0]
            yield from ((name, x) for x in found)


def lexed(text: str) -> list[tuple[int, int]]:
    """Places of the parts of literals that a sensitive name ends up with."""
    found: list[tuple[int, int]] = []
    for name, x in Reader(text).pairs():
        if x.length >= LEAST_LITERAL and (n := name_score(name)) >= LEAST_NAME:
            value = "".join(text[a:b] for a, b in x.pieces)
            total = n + literal_score(value)
            if x.quoted:
                total -= NO_DIGIT * (not DIGIT.search(value)) + SPACES * sum(c.isspace() for c in value) / len(value)
            if total >= LEAST_TOTAL and not PLACEHOLDERS.match(value):
                found += x.spans
    return found


def scan(raw: bytes | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of one text as (start, kind's place in KINDS, end), in code points, sorted."""
    if not raw:
        return [], []
    base: list[tuple[int, int, int]] = []
    text = None
    lower = raw.lower()
    if any(w in lower for w in WORDS_BEFORE_ASSIGN):
        text = raw.decode("utf-8", "replace")
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        text = text if text is not None else raw.decode("utf-8", "replace")
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    done = chars = 0
    for m in HEX.finditer(raw):  # a run of at least 24 is a whole run that passes; bytes before it become code points
        chars += len(raw[done:m.start()].decode("utf-8", "replace"))
        base.append((chars, 2, chars + m.end() - m.start()))
        done, chars = m.end(), chars + m.end() - m.start()
    base.sort()
    more: set[tuple[int, int]] = set()
    if b"=" in raw or b":" in raw:
        text = text if text is not None else raw.decode("utf-8", "replace")
        covered = [(a, b) for a, _, b in base]
        more = {(a, b) for a, b in lexed(text) if not any(x <= a and b <= y for x, y in covered)}
    return base, sorted({*base, *((a, 3, b) for a, b in more)})


def listed(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


COUNTS, TEXTS = ("n_assign", "n_access", "n_hex", "n_lexed"), ("base_sha256", "spans")


@F.arrow_udf(T.StructType([T.StructField(n, T.LongType()) for n in COUNTS] + [T.StructField(n, T.StringType()) for n in TEXTS]))
def findings(text: pa.Array) -> pa.Array:
    rows = []
    for raw in text.cast(pa.binary()).to_pylist():
        base, spans = scan(raw)
        rows.append((*(sum(k == i for _, k, _ in spans) for i in range(4)), sha256(listed(base).encode()).hexdigest(), listed(spans)))
    kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                      [*COUNTS, *TEXTS])


def redacted(raw: bytes | None) -> str | None:
    """The text with every span, overlapping ones as one, replaced by the name of its first kind."""
    if raw is None:
        return None
    text = raw.decode("utf-8", "replace")
    out, done = [], 0
    for a, k, b in scan(raw)[1]:
        if a >= done:
            out += [text[done:a], f"<{KINDS[k]}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


@F.arrow_udf(T.StringType())
def redact(text: pa.Array) -> pa.Array:
    return pa.array([redacted(raw) for raw in text.cast(pa.binary()).to_pylist()], pa.string())


def find_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: id, counts by kind, the checksum of the base spans and all spans as text.

    Null and empty texts have no spans and the checksum of an empty list.
    Repeated rows give repeated rows, a null id stays null, an empty table gives
    no rows; further columns are not read.
    """
    bounded_batches(df.sparkSession)
    found = df.select(column(id_column).alias("id"), findings(column(text_column)).alias("f"))
    return found.select(F.col("id").alias(id_column), "f.*")


def redact_secrets(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with every secret in its texts replaced by its kind; rows and other columns stay."""
    bounded_batches(df.sparkSession)
    return df.withColumn(text_column, redact(column(text_column)))
