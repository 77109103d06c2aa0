"""Secret scan by assignment-aware lexing.

Three base patterns are matched first (their spans are fixed by contract).  Then the text is lexed as source and
configuration syntax: every assignment mark (``=``, ``:``, ``:=``, ``=>``, a ``<tag>`` body) is read outwards into a
*name* on its left and a *value* on its right.  Values are literals (quoted in any of the usual ways, over one or more
lines, in parts that are concatenated, as lists, as YAML blocks, as the default behind ``||``, ``??`` or ``or``; or bare up
to a delimiter) or references to other names, also from inside an interpolated string.  Constants propagate: a literal bound to a name reaches every name that is assigned from it, through
any number of steps and in either order of lines.  A literal is reported as kind ``literal`` when the most sensitive
name it reaches, together with its own shape, scores at least ``MIN_SCORE``.

Edge cases: a null text counts as empty; an empty text has no spans; repeated rows give repeated results; null ids
stay null; extra columns are ignored; a long text is scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from spindle.llm.common import pick, sheltered, slices

KINDS = ("assign", "access", "hex", "literal")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a greedy run is maximal, so the length test can be part of the pattern

Span = tuple[int, int, str]  # start, end, kind

# Lexer ---------------------------------------------------------------------------------------------------------
MARK = re.compile(r"=>|:=|(?<![=!<>:])=(?!=)|:(?![:/])")
NAME_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-"
# No bound on any length: every repetition is possessive and ends at a character the next part needs, so the scans of
# all marks together are linear in the text.
STRING = re.compile(
    r"""([rbufRBUF]{0,2})(?:\"{3}(?P<triple>(?:(?!\"{3})[\s\S])++)\"{3}|'{3}(?P<single3>(?:(?!'{3})[\s\S])++)'{3}"""
    r"""|"(?P<double>(?:[^"\\\n]++|\\.)++)"|'(?P<single>(?:[^'\\\n]++|\\.)++)'|`(?P<back>[^`]++)`)"""
)
#: Before a string: blanks, one line break, or an opening bracket with any white space behind it.
OPEN = re.compile(r"[\x20\t]*+(?:\\?\n[\x20\t]*+|([(\[])\s*+)?")
KEY_MARK = re.compile(r"[\x20\t]*+[:=]")
#: Between the parts of one value, outside and inside brackets; there a comma begins the next value of a list.
JOIN = re.compile(r"\s*+(\+|&|\.{1,2})\s*+|[\x20\t]*+(?:\\\n[\x20\t]*+)?")
JOIN_INSIDE = re.compile(r"\s*+([+&,]|\.{1,2})?\s*+")
DEFAULT = re.compile(r"[\x20\t]*+(?:\|\||\?\?|or\b)")
INTERPOLATED = re.compile(r"(\$?)\{([A-Za-z_][A-Za-z0-9_.]*+)\}")
YAML_BLOCK = re.compile(r"[\x20\t]*+[|>][+-]?[\x20\t]*+\n([\x20\t]++)(\S[^\n]*+(?:\n\1[^\n]*+)*+)")
YAML_LIST = re.compile(r"[\x20\t]*+\n((?:[\x20\t]*+-[\x20\t]++[^\n]++(?:\n|\Z))++)")
YAML_ITEM = re.compile(r"""^[\x20\t]*+-[\x20\t]++["']?([^\s"'`,;(){}\[\]<>|:=]++)["']?[\x20\t]*+$""", re.MULTILINE)
NEXT_LINE = re.compile(r"""[\x20\t]*+\n[\x20\t]++([^\s"'`,;(){}\[\]<>|:=]++)[\x20\t]*+(?=\n|\Z)""")
BARE = re.compile(r"""[\x20\t]*+([^\s"'`,;(){}\[\]<>|]++)""")
REFERENCE = re.compile(r"""[\x20\t]*+(?:\$\{?|%\()?([A-Za-z_][A-Za-z0-9_.\-]*+)\}?(?=[\s,;)}\]]|$)""")
# An authentication scheme word with its token behind it.
SCHEME = re.compile(r"""[\x20\t]*+(?:Bearer|Basic|Token|Digest|Negotiate|ApiKey)[\x20\t]++(?=[^\s"'`,;(){}\[\]<>|])""", re.IGNORECASE)
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]++ )*?PRIVATE KEY(?: BLOCK)?-----")
#: A whole PEM block as a value, over as many lines as it has; the next head ends the search for its end.
PEM_VALUE = re.compile(
    r"""[\x20\t]*+["']?(-----BEGIN ((?:[A-Z0-9]++ )*?PRIVATE KEY(?: BLOCK)?)-----(?:(?!-----(?:BEGIN|END) )[\s\S])*+-----END \2-----)"""
)
TAG = re.compile(r"<([A-Za-z_][\w.\-]*+)>([^<>\n]++)</\1>")

SENSITIVE = {  # part of a target name -> weight
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5, "apikey": 3.0,
    "accesskey": 3.0, "privatekey": 3.0, "secretkey": 3.0, "credential": 2.5, "credentials": 2.5, "auth": 1.5,
    "authorization": 1.5, "bearer": 2.5, "signature": 1.5, "key": 1.0, "salt": 1.0, "cert": 1.0,
}
PLAIN = {"", "true", "false", "null", "none", "nil", "undefined", "changeme", "example", "test", "required", "optional"}
PLACEHOLDER = re.compile(r"^(?:[x*.\-_]+|<.*>|\$\{.*\}|\{\{.*\}\}|your[-_ ].*)$", re.IGNORECASE)
MIN_SCORE = 4.0
MIN_LITERAL = 6


def name_parts(name: str) -> set[str]:
    """``dbPassword``, ``DB_PASSWORD`` and ``db.pass-word`` in lower-case parts, with neighbours joined too."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z0-9]+", name)]
    return set(parts) | {a + b for a, b in zip(parts, parts[1:], strict=False)}


def name_weight(name: str) -> float:
    return max((SENSITIVE.get(p, 0.0) for p in name_parts(name)), default=0.0)


def literal_weight(value: str) -> float:
    """How far a literal looks like a generated credential: length, character classes, entropy; negative if plain.

    White space counts against it by its share, so a passphrase or a key of many lines is not ruled out by its length.
    A private key's PEM head is a credential under any name.
    """
    if PEM.match(value):
        return MIN_SCORE
    if len(value) < MIN_LITERAL or value.lower() in PLAIN or PLACEHOLDER.match(value):
        return -10.0
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    spaces = sum(c.isspace() for c in value) / len(value)
    return min(len(value), 32) / 32 + entropy / 4 + (classes >= 2) - spaces


def name_before(left: str) -> str:
    """The name that ends ``left``, before closing quotes or a bracket and any run of blanks; empty if there is none."""
    left = left.removesuffix("\n").rstrip(" \t")
    for _ in range(2):
        left = left[:-1] if left.endswith(('"', "'", "]")) else left
    return left[len(left.rstrip(NAME_CHARS)) :].lstrip("0123456789.-")


def under_scheme(name: str, refs: list[tuple[str, str]]) -> str:
    """The name a token after a scheme word is bound to: under an authorization it weighs as a bearer token."""
    if not name_parts(name) & {"auth", "authorization"}:
        return name
    refs.append((name, f"{name}.bearer"))
    return f"{name}.bearer"


def strings_at(text: str, at: int, fold: bool) -> tuple[list[tuple[int, int, str]], list[str], int]:
    """``(start, end, value)`` of the strings that begin at ``at``, the names they interpolate, and where they end.

    With ``fold``, parts joined by an operator or standing side by side are one value, whose stretch covers all of them
    with what is between; inside brackets a comma begins another value.
    """
    before = OPEN.match(text, at)
    m = STRING.match(text, before.end())
    if not m or ("\n" in before.group() and not before.group(1) and KEY_MARK.match(text, m.end())):
        return [], [], at
    join = JOIN_INSIDE if before.group(1) else JOIN
    out: list[tuple[int, int, str]] = []
    names: list[str] = []
    (start, end), parts = m.span(m.lastgroup), []
    while True:
        value = m[m.lastgroup]
        parts.append(value)
        literal_braces = "f" not in m[1].lower()
        names += [n for dollar, n in INTERPOLATED.findall(value) if dollar or not literal_braces]
        end = m.end(m.lastgroup)
        link = join.match(text, m.end()) if fold else None
        after = STRING.match(text, link.end()) if link else None
        if after is None:
            break
        if link.group(1) == ",":
            out.append((start, end, "".join(parts)))
            start, parts = after.start(after.lastgroup), []
        m = after
    return [*out, (start, end, "".join(parts))], names, m.end()


def lex(text: str) -> tuple[list[tuple[str, int, int, str]], list[tuple[str, str]]]:
    """``(name, start, end, value)`` of literals bound to names, and ``(target, source)`` references between names.

    Marks inside a value of several parts, a block or a list bind what follows them too, but are not folded again."""
    literals: list[tuple[str, int, int, str]] = []
    refs: list[tuple[str, str]] = []
    at = folded = 0

    def bind(name: str, begin: int, fresh: bool) -> int:
        strings, names, stop = strings_at(text, begin, fresh)
        for start, end, value in strings:
            bound = under_scheme(name, refs) if SCHEME.match(text, start, end) else name
            literals.append((bound, start, end, value))
        refs.extend((name, source) for source in names)
        return stop if strings else 0

    for mark in MARK.finditer(text):
        name = name_before(text[at : mark.start()])  # a name holds no mark, so it begins after the one before
        at = mark.end()
        if not name:
            continue
        fresh = mark.start() >= folded
        if m := PEM_VALUE.match(text, at):
            literals.append((name, m.start(1), m.end(1), m[1]))
            continue
        if stop := bind(name, at, fresh):
            folded = max(folded, stop)
            continue
        if fresh and mark.group() == ":":
            if m := YAML_BLOCK.match(text, at):
                literals.append((name, m.start(2), m.end(2), m[2]))
                folded = m.end()
                continue
            if m := YAML_LIST.match(text, at):
                literals += [(name, *i.span(1), i[1]) for i in YAML_ITEM.finditer(text, m.start(1), m.end(1))]
                folded = m.end()
                continue
        if m := NEXT_LINE.match(text, at):
            literals.append((name, m.start(1), m.end(1), m[1]))
            continue
        start, bound = at, name
        if m := SCHEME.match(text, start):  # the value is the token after the scheme word
            if whole := REFERENCE.match(text, start):
                refs.append((name, whole.group(1)))
            start, bound = m.end(), under_scheme(name, refs)
        if m := REFERENCE.match(text, start):
            refs.append((name, m.group(1)))
            default = DEFAULT.match(text, m.end())
            if default and (stop := bind(name, default.end(), fresh)):  # then what stands before it is a name, not a value
                folded = max(folded, stop)
                continue
        if m := BARE.match(text, start):
            literals.append((bound, m.start(1), m.end(1), m[1]))
    literals += [(m.group(1), m.start(2), m.end(2), m[2]) for m in TAG.finditer(text)]
    return literals, refs


def literal_spans(text: str) -> list[Span]:
    """Spans of literals that reach a sensitive name, after propagation over references."""
    literals, refs = lex(text)
    if not literals:
        return []
    weight = {n: name_weight(n) for n in {n for n, *_ in literals} | {t for t, _ in refs} | {s for _, s in refs}}
    targets: dict[str, list[str]] = {}
    for target, source in refs:
        targets.setdefault(source, []).append(target)
    # The weight of a target flows back to every name it is assigned from: heaviest names first, each name once.
    reach: dict[str, float] = {}
    sources: dict[str, list[str]] = {}
    for source, ts in targets.items():
        for t in ts:
            sources.setdefault(t, []).append(source)
    for name in sorted(weight, key=lambda n: (-weight[n], n)):
        todo = [name]
        while todo:
            x = todo.pop()
            if x not in reach:
                reach[x] = weight[name]
                todo += sources.get(x, ())
    found = {
        (start, end, "literal")
        for name, start, end, value in literals
        if (reach[name] > 0 or PEM.match(value)) and reach[name] + literal_weight(value) >= MIN_SCORE
    }
    return sorted(found)


def base_spans(text: str) -> list[Span]:
    """The contract's spans: leftmost non-overlapping matches of each kind; a match that fails its length is dropped."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def all_spans(text: str) -> list[Span]:
    return sorted(base_spans(text) + literal_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, mask: str = "[SECRET]") -> str:
    """The text with every reported stretch replaced by ``mask``; overlapping spans are one stretch.

    A base ``assign`` span keeps its name and mark: only the value is masked.
    """
    cuts = []
    for start, end, kind in all_spans(text):
        if kind == "assign":
            start = ASSIGN.match(text, start, end).start(2)
        cuts.append((start, end))
    out, at = [], 0
    for start, end in sorted(cuts):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCAN_SCHEMA = "doc_id BIGINT, n_assign BIGINT, n_access BIGINT, n_hex BIGINT, base_sha256 STRING, spans STRING, n_literal BIGINT"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans and all spans.

    Spans are in code points, end exclusive.  Map-side only: no shuffle.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            base, spans = [], []
            for text in b.column("text").to_pylist():
                base.append(base_spans(text or ""))
                spans.append(sorted(base[-1] + literal_spans(text or ""), key=lambda s: (s[0], KINDS.index(s[2]), s[1])))
            count = lambda kind, of: pa.array([sum(k == kind for _, _, k in s) for s in of], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    *(count(k, base) for k in KINDS[:3]),
                    pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base]),
                    pa.array([joined(s) for s in spans], pa.string()),
                    count("literal", spans),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(kernel, SCAN_SCHEMA)


def redact_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with found secrets masked in ``text``; ``n_chars``, where there is such a column, follows.

    Null texts stay null; the other columns pass through.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = [None if t is None else redact(t, mask) for t in b.column("text").to_pylist()]
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            columns["text"] = pa.array(texts, b.schema.field("text").type)
            if "n_chars" in columns:
                n = [None if t is None else len(t) for t in texts]
                columns["n_chars"] = pa.array(n, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in b.schema.names], b.schema.names)

    docs, names = sheltered(docs, "text", "n_chars")
    return docs.mapInArrow(kernel, docs.schema).toDF(*names)
