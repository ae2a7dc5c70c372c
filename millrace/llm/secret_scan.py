"""Secret scans: base patterns, and an assignment-aware lexer that follows constants to sensitive names."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_type, small_batches, text_list

# The base patterns and the least sizes of their matches.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_SIZE = 12, 18
KINDS = ("assign", "access", "hex", "literal")

# Words that make a name sensitive, and how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "private": 0.6, "auth": 0.6, "bearer": 0.8, "access": 0.4, "key": 0.5,
    "signing": 0.5, "encryption": 0.5, "client": 0.2, "api": 0.4, "salt": 0.5,
}
HARMLESS = frozenset("example sample changeme placeholder test dummy none null true false undefined todo".split())

# Every repetition is possessive, and a name without an assignment is taken whole: time is linear in long names and blanks.
NAME = r"[A-Za-z_$][\w$]*+(?:[.\-][A-Za-z_$][\w$]*+)*+"
PREFIX = r"""(?:[rbfuRBFU]{1,2}(?=["']))?+"""  # of string literals
QUOTED = PREFIX + r"""(?: "[^"\\\n]*+(?:\\.[^"\\\n]*+)*+" | '[^'\\\n]*+(?:\\.[^'\\\n]*+)*+' )"""
LEXEME = re.compile(rf"""(?ax)
    (?P<comment> (?:^|(?<=\s))(?:\#|//) )
  | (?P<name> {NAME} | "{NAME}"(?=\]?+\s*+[:=?]) | '{NAME}'(?=\]?+\s*+[:=?]) )
    (?:(?<=["'])\])?+ [^\S\n]*+ (?: :\s*+[A-Za-z_][\w\[\]]*+ [^\S\n]*+ (?==) )? (?P<sign> :=|\?=|=>|=(?!=)|:(?!:) ) [^\S\n]*+
    (?P<value> (?: {QUOTED} | `[^`\n]*+` | {NAME} (?=\s*(?:[;,)\n+]|$)) | [^\s"'`,;(){{}}\[\]]++ (?![(\[]) )
      (?: [^\S\n]*+ \+ [^\S\n]*+ (?: {QUOTED} | {NAME} ) )*+ )
  | {NAME}
""")
OPERAND = re.compile(
    rf"""(?a){PREFIX}(?:"([^"\\]*+(?:\\.[^"\\]*+)*+)"|'([^'\\]*+(?:\\.[^'\\]*+)*+)')|`([^`]*+)`|({NAME})(?![^\s+])|([^\s+]+)""")
PHRASE = re.compile(r"[A-Za-z]+(?:[._-][A-Za-z]+)+")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start and kind; ends exclusive, in code points."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_SIZE]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def name_weight(name: str) -> float:
    """How sensitive a target name is: the weights of its words together, at most 1."""
    parts = [p.lower() for p in PARTS.findall(name)]
    joined = "".join(parts)
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in parts) + (1.0 if "apikey" in joined else 0.0))


def literal_strength(value: str) -> float:
    """How much a literal looks random, 0 to 1: bits per character and size; harmless words, phrases and
    words joined by dots, dashes or underscores are 0."""
    if len(value) < 8 or any(c.isspace() for c in value) or value.lower().strip("<>{}$%*._-") in HARMLESS:
        return 0.0
    if len(set(value)) < 4 or PHRASE.fullmatch(value) or value.startswith(("http://", "https://", "${", "{{", "<")):
        return 0.0
    counts = Counter(value)
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    classes = sum((any(map(str.isdigit, value)), any(map(str.islower, value)), any(map(str.isupper, value)),
                   any(not c.isalnum() for c in value)))
    return min(1.0, bits / 4.0) * min(1.0, len(value) / 12) * (0.4 + 0.3 * min(classes - 1, 2))


def lexemes(text: str) -> Iterator[tuple[re.Match, bool]]:
    """Assignments of a text, and whether each stands in a comment: from its sign to the end of the line."""
    at, end, inside = 0, len(text), False
    while True:
        m = LEXEME.search(text, at, end)
        if m is None:
            if not inside:
                return
            at, end, inside = end, len(text), False
            continue
        at = m.end()
        if m["name"] is not None:
            yield m, inside
        elif m["comment"] is not None and not inside:
            stop = text.find("\n", at)
            end, inside = len(text) if stop < 0 else stop, True


def assignments(text: str, *, comments: bool = False) -> Iterator[tuple[str, str, tuple[tuple[int, int], ...]]]:
    """(name, literal, spans of the literal's parts) of assignments in source and configuration syntax.

    ``name = "literal"``, ``name: literal``, ``"name": "literal"``, ``name := ...``, typed and
    dotted names, sums of literals and names. A name assigned before stands for its literal, and
    the spans are those of the literals themselves. Comments are passed over, or read too with
    ``comments``; what they assign holds in comments only.
    """
    constants: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
    commented: dict[str, tuple[str, tuple[tuple[int, int], ...]] | None] = {}
    for m, inside in lexemes(text):
        if inside and not comments:
            continue
        name, base = m["name"].strip("\"'"), m.start("value")
        value, spans, known = [], [], True
        for o in OPERAND.finditer(m["value"]):
            group = o.lastindex
            held = None
            if group == 4:
                held = commented[o[4]] if inside and o[4] in commented else constants.get(o[4])
            if held is not None:
                literal, where = held
                value.append(literal)
                spans += where
            elif group == 4 and "+" in m["value"]:
                known = False
            else:
                value.append(o[group])
                spans.append((base + o.start(group), base + o.end(group)))
        new = ("".join(value), tuple(spans)) if known and value else None
        if inside:
            commented[name] = new
        else:
            commented.pop(name, None)
            constants.pop(name, None)
            if new is not None:
                constants[name] = new
        if new is not None:
            yield name, *new


def literal_spans(text: str, threshold: float = 0.55) -> list[tuple[int, int, int]]:
    """(start, kind, end) of literals whose strength times their target name's weight reaches the threshold."""
    found = set()
    for name, value, spans in assignments(text, comments=True):
        weight = name_weight(name)
        if weight * 1.0 >= threshold and weight * literal_strength(value) >= threshold:
            found.update((start, 3, end) for start, end in spans if end > start)
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: the base ones and the lexer's, by start and kind."""
    base = base_spans(text)
    extra = literal_spans(text) if "=" in text or ":" in text else []
    return base, sorted(base + extra)


def scan_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal``.

    Spans are ``kind:start:end`` in code points. Null and empty texts have none; their digest is
    that of the empty string. Null ids and repeated rows stay as they are.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = []
            for text in text_list(batch, "text"):
                base, spans = scan(text)
                n = Counter(kind for _, kind, _ in spans)
                rows.append((n[0], n[1], n[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), n[3]))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns, kinds)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        find, f"doc_id {id_type(docs, id_col)}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "n_literal long")


def redact(text: str, mark: str = "[secret]") -> str:
    """The text with each run of overlapping spans replaced by a mark."""
    out, at = [], 0
    for start, _, end in scan(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, *, text_col: str = "text", size_col: str | None = "n_chars", mark: str = "[secret]") -> DataFrame:
    """All rows and columns, secrets in ``text_col`` replaced and ``size_col``, if there, set to the new length.

    A text without secrets stays as it is, a null text stays null.
    """
    schema = docs.schema
    names = schema.names

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            old = batch.column(text_col).to_pylist()
            new = [None if t is None else redact(t, mark) for t in old]
            columns = dict(zip(names, batch.columns))
            columns[text_col] = pa.array(new, batch.schema.field(text_col).type)
            if size_col in columns:
                kind = batch.schema.field(size_col).type
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, columns[size_col].to_pylist())]
                columns[size_col] = pa.array(sizes, kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(clean, schema)
