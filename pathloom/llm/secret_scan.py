"""Secrets in texts: fixed patterns, and literals that source or configuration assigns to
sensitive names.

The assignment-aware part lexes ``name = value``, ``name: value``, ``"name" => value`` and the
like into pairs of a name and the literals or names on the right (joined by ``+``), follows
names to the literals they hold anywhere in the same text, and scores each literal by the name
it ends up under. Everything is linear in the text and done row by row, with no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base kinds with their patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs of [0-9a-f]+ that are long enough
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
KINDS = ("assign", "access", "hex", "literal")  # in order; the last one is the method's own

MARK = "[SECRET]"

# What a name has to contain to be sensitive, and how much that says.
SENSITIVE = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "token": 3, "apikey": 3, "accesskey": 3,
             "privatekey": 3, "signingkey": 3, "encryptionkey": 3, "credential": 3, "connectionstring": 2, "auth": 1}
# Whole words of a name that make it harmless.
HARMLESS_NAMES = re.compile(r"(?:length|size|count|limit|url|uri|path|file|filepath|(?:user|file|path|host|type)?name|type)s?|max|min|ttl|expir.*|author(?!i[sz]).*|tokeni[sz].*")
PLACEHOLDERS = re.compile(r"""(?ix) ^(?: none|null|nil|true|false|undefined|todo|changeme|example|placeholder|password|secret|token
                              |redacted|default|string|str|bytes|test|x+|\*+|\.+|-+ )$ | ^(?: \$\{[^}]*\} | \{\{.*\}\} | %\([^)]*\)[sd] | <[^<>]*> | (?-i:\$[A-Z][A-Z0-9_]*) )$ | your[_-]""")
LEAST_SCORE = 5
QUOTED_SCORE = 4  # of a quoted literal under a name of weight 3
LEAST_CHARS = 6

_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SENSITIVE = re.compile("(?:" + "|".join(s for s in SENSITIVE if s != "auth") + ")s?")
_PHRASED = re.compile("(?:" + "|".join(s for s, weight in SENSITIVE.items() if weight == 3) + ")$")
_STEMS = re.compile("|".join(sorted({"passw", "passph", "pwd", "secret", "token", "key", "credential", "connection", "auth"})))
_PAIR = re.compile(r"""(?<![\w.\-])(["'`]?)([A-Za-z_][\w.\-]{0,127})\1(?:[ \t]*\])?[ \t]*(?::=|=>|=(?!=)|:(?!:))[ \t]*""")
_ATOM = re.compile(r"""[bBrRuUfF]{0,2}(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`((?:[^`\\\n]|\\.)*)`)|([^\s,;"'`(){}\[\]<>=:]+={0,2})""")
_MORE = re.compile(r"[ \t]*(?:\+[ \t]*)")
_ANNOTATED = re.compile(r"[ \t]*=(?!=)[ \t]*")
_NAME = re.compile(r"[A-Za-z_][\w.\-]{0,127}\Z")
_HEX_BYTES = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping within a kind."""
    found: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if b"1" * 24 in text.encode().translate(_HEX_BYTES):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int, bool]]]]:
    """Assigned names with the values on the right: (start, end, whether it is a quoted literal)."""
    at = 0
    while m := _PAIR.search(text, at):
        values, end = [], m.end()
        while atom := _ATOM.match(text, end):
            group = next(g for g in (1, 2, 3, 4) if atom[g] is not None)
            values.append((*atom.span(group), group < 4))
            end = atom.end()
            if group == 4 and (note := _ANNOTATED.match(text, end)) and len(values) == 1:  # name: type = value
                values, end = [], note.end()
            elif more := _MORE.match(text, end):
                end = more.end()
            else:
                break
        yield m[2], values
        # a bare value may itself begin a pair, as in "note: password = x"
        at = m.end() if values and not values[0][2] else max(end, m.end())


def _plain(name: str) -> str:
    return re.sub(r"[_.\-]", "", name).lower()


def sensitivity(name: str) -> int:
    """How sensitive a target name is; 0 for ordinary ones."""
    plain = _plain(name)
    weight = max((weight for stem, weight in SENSITIVE.items() if stem in plain), default=0)
    # words as they are, and what sensitive words written together with others leave of them
    if weight and any(HARMLESS_NAMES.fullmatch(w) or HARMLESS_NAMES.fullmatch(_SENSITIVE.sub("", w)) for w in map(str.lower, _NAME_WORDS.findall(name))):
        return 0
    return weight


def literal_score(literal: str, phrase: bool = False) -> int:
    """How much a literal looks like a secret by itself; negative for placeholders, and for
    texts with white space unless they may be a pass phrase."""
    if len(literal) < LEAST_CHARS or PLACEHOLDERS.search(literal):
        return -9
    if any(c.isspace() for c in literal) and (not phrase or _SENSITIVE.search(literal.lower())):
        return -9
    classes = [any(c.islower() for c in literal), any(c.isupper() for c in literal), any(c.isdigit() for c in literal),
               any(not c.isalnum() for c in literal)]
    return sum(classes) - 1 + (len(set(literal)) >= 8) + (len(literal) >= 16)


def literal_spans(text: str) -> list[Span]:
    """Literals that assignments, also through other names, put under sensitive names."""
    if not _STEMS.search(text.lower()):
        return []
    held: dict[str, list[tuple[int, int, bool]]] = {}
    targets: list[tuple[int, bool, list[tuple[int, int, bool]]]] = []  # weight, whether a pass phrase may follow
    for name, values in pairs(text):
        held.setdefault(name, []).extend(values)
        if weight := sensitivity(name):
            targets.append((weight, bool(_PHRASED.search(_plain(name))), values))
    found: set[tuple[int, int]] = set()
    seen: set[tuple[int, bool, str]] = set()  # a name is followed once for each weight and kind
    for weight, phrase, values in targets:
        todo = list(values)
        while todo:
            start, end, quoted = todo.pop()
            bare = text[start:end]
            if not quoted and _NAME.match(bare) and bare in held:
                if (weight, phrase, bare) not in seen:
                    seen.add((weight, phrase, bare))
                    todo += held[bare]
            elif weight + literal_score(bare, phrase and quoted) >= (QUOTED_SCORE if quoted and weight == 3 else LEAST_SCORE):
                found.add((start, end))
    return [(start, 3, end) for start, end in found]


def spans(text: str) -> list[Span]:
    """All spans by start, then kind: the base ones, and literals that no base span covers."""
    base = sorted(base_spans(text))
    starts, ends = [s[0] for s in base], list(accumulate((s[2] for s in base), max))

    def covered(start: int, end: int) -> bool:
        before = bisect_right(starts, start)
        return before > 0 and ends[before - 1] >= end

    return sorted(base + [s for s in literal_spans(text) if not covered(s[0], s[2])])


def redacted(text: str, found: list[Span], mark: str = MARK) -> str:
    """The text with every span, overlapping ones together, replaced by the mark."""
    parts, at = [], 0
    for start, end in sorted((s[0], s[2]) for s in found):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)`` per row: the spans in the whole text as an array of (kind, start,
    end) in code points, by start and then kind.

    A null text counts as empty; it has an empty array. Null ids and repeated rows stay. An
    empty table gives an empty one.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact_secrets(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, with the secrets in ``text`` replaced by the mark and
    ``n_chars``, if there is such a column, set to the new length. Texts without secrets, null
    texts among them, keep both as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(text)).to_pylist()
            found = [spans(t) if t else [] for t in texts]
            columns = list(batch.columns)
            if any(found):
                texts = [redacted(t, s) if s else t for t, s in zip(texts, found)]
                columns[names.index(text)] = pa.array(texts, columns[names.index(text)].type)
                if n_chars in names:
                    kept = columns[names.index(n_chars)]
                    sizes = [len(t) if s else n for t, s, n in zip(texts, found, kept.to_pylist())]
                    columns[names.index(n_chars)] = pa.array(sizes, kept.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
