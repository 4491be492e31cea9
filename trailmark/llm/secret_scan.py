"""Secrets in texts, found by one deterministic automaton for all rules.

1. Compiling.  Every rule's regex becomes a nondeterministic automaton over bytes; the reversed
   ones of all rules are joined, made deterministic by subset construction, minimised by
   partition refinement and laid out as one transition array over byte classes.
2. Scanning.  One pass over the bytes, right to left, drives the joined automaton: after reading
   the byte at a position its state names the rules that have a match *starting* there.
   Texts are cut into lanes at bytes that bring every state back to the first one (among them the
   separator between texts, a byte that UTF-8 never holds), and all lanes of a block advance
   together, one array lookup a step.
3. Spans.  From the leftmost marked start the rule's own forward automaton gives the longest
   match; starts inside it are passed over.  So matches are leftmost, longest and do not
   overlap within a rule.  A rule may name a head: the rest of the match is then its value.
   Matches whose value is shorter than ``least`` code points are dropped after they have been
   passed over, as a match that fails still uses up its text.

The regexes are byte patterns without anchors, look-around, back references or lazy
repeats; of two ways to match, the longest counts.  Spans are code points, end exclusive.

Defined cases: a null text is empty and has no spans; texts of any length are read whole;
repeated rows give repeated results; an empty table gives no rows; extra columns are
not carried.  Row by row, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Bytes scanned at once, the byte between texts, and lanes below which each goes on alone.
BLOCK_BYTES, SEPARATOR, FEW_LANES = 1 << 22, 0xFF, 64
#: States a joined automaton may have at most; more is an error that names the limit.
MAX_STATES = 1 << 15


class Rule(NamedTuple):
    """A kind of secret: ``head`` then ``value`` (regexes), and the code points its value has at least."""

    kind: str
    head: str
    value: str
    least: int = 1


# The base rules.  Only the hex run counts inside its regex (a shorter maximal run holds no
# longer one, so that finds the same matches): without a head every hex digit would mark a start.
# Counts in several rules would multiply the states of the joined automaton, so the others use ``least``.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?""",
         "[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", "AKIA", "[A-Z0-9]+", 12),
    Rule("hex", "", "[0-9a-f]{32,}"),
)
# Further rules, by the published formats of these keys.
MORE_RULES = (
    Rule("github", "gh[opsur]_", "[A-Za-z0-9]+", 36),
    Rule("google", "AIza", "[A-Za-z0-9_-]+", 35),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]+", 10),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]+", 8),
    Rule("private_key", "", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)


# ------------------------------------------------------------------ regex -> automaton
class _Nfa:
    """Nondeterministic automaton under construction: edges on byte sets, and empty edges."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)


def _bytes_of(op: str, arg) -> frozenset[int]:
    """The bytes of a one-byte node of the parsed regex."""
    if op == "LITERAL":
        return frozenset([arg])
    if op == "NOT_LITERAL":
        return frozenset(range(256)) - {arg}
    if op == "RANGE":
        return frozenset(range(arg[0], arg[1] + 1))
    if op == "ANY":
        return frozenset(range(256)) - {10}
    if op == "IN":
        negated = bool(arg) and str(arg[0][0]) == "NEGATE"
        found: set[int] = set()
        for kind, value in arg[negated:]:
            found |= _bytes_of(str(kind), value)
        return frozenset(range(256)) - found if negated else frozenset(found)
    raise ValueError(f"{op} is not supported in a rule")


def _add(nfa: _Nfa, parsed, start: int, backward: bool) -> int:
    """Adds the parsed regex after ``start`` (read from its end if ``backward``); returns its last state."""
    items = list(parsed)
    for op, arg in reversed(items) if backward else items:
        name = str(op)
        if name == "SUBPATTERN":
            start = _add(nfa, arg[-1], start, backward)
        elif name == "BRANCH":
            end = nfa.state()
            for branch in arg[1]:
                nfa.empty[_add(nfa, branch, start, backward)].append(end)
            start = end
        elif name == "MAX_REPEAT":
            least, most, inner = arg
            for _ in range(least):
                start = _add(nfa, inner, start, backward)
            if str(most) == "MAXREPEAT":
                loop = nfa.state()
                nfa.empty[start].append(loop)
                nfa.empty[_add(nfa, inner, loop, backward)].append(loop)
                start = loop
            else:
                end = nfa.state()
                for _ in range(most - least):
                    nfa.empty[start].append(end)
                    start = _add(nfa, inner, start, backward)
                nfa.empty[start].append(end)
                start = end
        else:
            end = nfa.state()
            nfa.edges[start].append((_bytes_of(name, arg), end))
            start = end
    return start


class Automaton(NamedTuple):
    """Deterministic and minimal.  ``step[state * classes + byte_class[byte]]`` is the next state (0 is the first).

    ``accepts[state]`` has bit i set if rule i ends in the state.
    """

    step: np.ndarray
    byte_class: np.ndarray
    classes: int
    accepts: np.ndarray


def _parse(pattern: str):
    return re._parser.parse(pattern.encode())  # the standard library's reading of the regex, without its engine


def compile_rules(patterns: list[str], backward: bool, anywhere: bool) -> Automaton:
    """One automaton for all patterns; ``anywhere``: a match may begin at any byte."""
    nfa = _Nfa()
    first = nfa.state()
    ends = {_add(nfa, _parse(p), _entry(nfa, first), backward): i for i, p in enumerate(patterns)}
    begin = nfa.closure([first])
    # byte classes: bytes that no edge tells apart
    signature = np.zeros(256, np.int64)
    for _, bytes_ in sorted({(tuple(sorted(b)), b) for edges in nfa.edges for b, _ in edges}):
        held = np.isin(np.arange(256), list(bytes_))
        signature = np.unique(signature * 2 + held, return_inverse=True)[1]
    classes = int(signature.max()) + 1
    examples = [int(np.flatnonzero(signature == c)[0]) for c in range(classes)]
    # subset construction
    number = {begin: 0}
    order, rows = [begin], []
    for subset in order:
        row = []
        for byte in examples:
            reached = nfa.closure({t for s in subset for held, t in nfa.edges[s] if byte in held} | ({first} if anywhere else set()))
            if reached not in number:
                if len(order) >= MAX_STATES:
                    raise ValueError(f"the rules need more than MAX_STATES={MAX_STATES} states")
                number[reached] = len(order)
                order.append(reached)
            row.append(number[reached])
        rows.append(row)
    accepts = np.array([sum({1 << ends[s] for s in subset if s in ends}) for subset in order], np.int64)
    return _minimised(np.array(rows, np.int64), accepts, signature, classes)


def _entry(nfa: _Nfa, first: int) -> int:
    own = nfa.state()
    nfa.empty[first].append(own)
    return own


def _minimised(rows: np.ndarray, accepts: np.ndarray, byte_class: np.ndarray, classes: int) -> Automaton:
    """Partition refinement: states are one if they accept alike and step into the same parts."""
    part = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([part, part[rows]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    # number the parts so that the first state is 0
    rename = np.full(part.max() + 1, -1)
    example = np.zeros(part.max() + 1, np.int64)
    example[part[::-1]] = np.arange(len(part))[::-1]
    by_first = np.argsort(example, kind="stable")
    rename[by_first] = np.arange(len(by_first))
    example = example[by_first]
    step = rename[part[rows[example]]]
    return Automaton(step.astype(np.int32).ravel(), byte_class.astype(np.int32), classes, accepts[example])


# ------------------------------------------------------------------ scanning
class Scanner:
    """All rules compiled: the joined automaton that marks starts, and each rule's own that measures."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.starts = compile_rules([r.head + r.value for r in rules], backward=True, anywhere=True)
        self.whole = [Matcher(r.head + r.value) for r in rules]
        self.heads = [Matcher(r.head) for r in rules]
        a = self.starts
        resets = (a.step.reshape(-1, a.classes) == 0).all(axis=0)
        if not resets[a.byte_class[SEPARATOR]]:
            raise ValueError("a rule may not match the byte 0xFF")
        self.resets = resets[a.byte_class]
        self.steps, self.accepts = a.step.tolist(), a.accepts.tolist()

    def marks(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, rule bits) of every byte where some rule's match starts, by position."""
        a = self.starts
        classes = a.byte_class[data]
        # a lane ends at (and holds) a reset byte's right neighbour: whatever stands right of it, it begins in state 0
        cuts = np.flatnonzero(self.resets[data])
        begin = np.concatenate([[0], cuts + 1])
        end = np.concatenate([cuts, [len(data)]])
        live = end > begin
        begin, end = begin[live], end[live]
        by_length = np.argsort(begin - end, kind="stable")  # longest first: lanes that are done drop off the end
        begin, end = begin[by_length], end[by_length]
        lengths = end - begin
        state = np.zeros(len(begin), np.int32)
        active = np.searchsorted(-lengths, -np.arange(1, int(lengths.max(initial=0)) + 1), "right")
        at, bits = [], []
        for k, n in enumerate(active.tolist()):
            if n < FEW_LANES:  # the few longest lanes go on one by one, which is quicker for few
                for lane in range(n):
                    found, hit = self._alone(classes[begin[lane]:end[lane] - k], int(state[lane]))
                    at.append(found + begin[lane])
                    bits.append(hit)
                break
            place = end[:n] - 1 - k
            s = a.step[state[:n] * a.classes + classes[place]]
            state[:n] = s
            hit = a.accepts[s]
            found = np.flatnonzero(hit)
            if len(found):
                at.append(place[found])
                bits.append(hit[found])
        if not at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        places, rules = np.concatenate(at), np.concatenate(bits)
        order = np.argsort(places, kind="stable")
        return places[order], rules[order]

    def _alone(self, classes: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray]:
        """The rest of one lane, right to left: (position, rule bits) of its marks."""
        step, width, accepts = self.steps, self.starts.classes, self.accepts
        found = []
        for back, c in enumerate(reversed(classes.tolist()), 1):
            state = step[state * width + c]
            if accepts[state]:
                found.append((len(classes) - back, accepts[state]))
        return np.array([f for f, _ in found], np.int64), np.array([b for _, b in found], np.int64)

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, ordered by rule and start."""
        places, bits = self.marks(np.frombuffer(data, np.uint8))
        found = []
        for i, rule in enumerate(self.rules):
            reached = 0
            starts = places[bits >> i & 1 == 1]
            k = 0
            while k < len(starts):
                start = int(starts[k])
                reached, value = self.whole[i].longest(data, start), self.heads[i].longest(data, start)
                if len(data[value:reached].decode(errors="replace")) >= rule.least:
                    found.append((start, reached, i))
                # a match is never empty here; starts inside it are passed over
                k = int(np.searchsorted(starts, max(reached, start + 1)))
        return found


class Matcher:
    """One rule's forward automaton, read byte by byte from a given start."""

    def __init__(self, pattern: str):
        a = compile_rules([pattern], backward=False, anywhere=False)
        rows = a.step.reshape(-1, a.classes)
        stuck = np.flatnonzero((rows == np.arange(len(rows))[:, None]).all(axis=1) & (a.accepts == 0))
        self.dead = int(stuck[0]) if len(stuck) else -1  # the state that never accepts again
        self.step, self.classes = a.step.tolist(), a.classes
        self.byte_class, self.accepts = a.byte_class.tolist(), a.accepts.tolist()

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at ``start`` (``start`` if there is none)."""
        state, end = 0, start
        for at in range(start, len(data)):
            state = self.step[state * self.classes + self.byte_class[data[at]]]
            if state == self.dead:
                break
            if self.accepts[state]:
                end = at + 1
        return end


def scan_texts(texts: list[str | None], compiled: Scanner) -> list[list[tuple[int, int, int]]]:
    """Per text its spans (start, end in code points, rule), ordered by start and rule."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        flat = bytes([SEPARATOR]).join(raw for _, raw in held)
        begins = np.cumsum([0, *[len(raw) + 1 for _, raw in held[:-1]]])
        for start, end, rule in compiled.spans(flat):
            k = int(np.searchsorted(begins, start, "right")) - 1
            i, raw = held[k]
            before = len(raw[:start - begins[k]].decode())
            out[i].append((before, before + len(flat[start:end].decode()), rule))
        held.clear()
        size = 0

    for i, text in enumerate(texts):
        if text:
            held.append((i, text.encode()))
            size += len(held[-1][1])
            if size >= BLOCK_BYTES:
                flush()
    if held:
        flush()
    return [sorted(x, key=lambda s: (s[0], s[2])) for x in out]


SPANS_SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """doc_id and the spans (kind, start, end) of every row, by start, then as the rules are listed."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    compiled = Scanner(rules)  # compiled once, on the driver; the tasks get its arrays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"kind": rules[r].kind, "start": s, "end": e} for s, e, r in found]
                     for found in scan_texts(b.column(1).to_pylist(), compiled)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SPANS_SCHEMA)


# ------------------------------------------------------------------ query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _equals(name: str) -> Callable[[Column], Column]:
    return lambda c: c == name


def _rule_sql(order: int, rule: Rule) -> str:
    """Spans of one rule: matches and the pieces between them alternate, so their lengths give the places."""
    pattern, head = ((rule.head + rule.value).replace("'", "''"), rule.head.replace("'", "''"))
    value = f"length(m) - length(regexp_extract(m, '^({head})'))" if head else "length(m)"
    return f"""SELECT r, doc_id, '{rule.kind}' AS kind, {order} AS o, {value} AS value_chars,
  list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[:i - 1], lambda x: length(x))), 0) AS s, length(m) AS n
FROM (SELECT r, doc_id, p, ms, unnest(ms) AS m, generate_subscripts(ms, 1) AS i
      FROM (SELECT r, doc_id, string_split_regex(text, '{pattern}') AS p, regexp_extract_all(text, '{pattern}') AS ms FROM d) WHERE len(ms) > 0)
WHERE value_chars >= {rule.least}"""


OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_rule_sql(i, rule) for i, rule in enumerate(BASE_RULES + MORE_RULES))}),
g AS (SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
  string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, o) FILTER (o < {len(BASE_RULES)}) AS base,
  string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, o) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""
