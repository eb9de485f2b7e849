"""Personal data by rules, and a skip-chain conditional random field for what the rules miss.

Rules find e-mail addresses, IP addresses, card numbers and phone numbers (``base_spans``). All
number-like and address-like stretches of a document are then the nodes of a random field with labels
none, email, ip, card, phone. Neighbouring nodes are linked in a chain; nodes with the same, or with a
similar, normal form are linked to one entity node of that form, however many there are and however far apart they
stand. Nodes that a rule has found keep its label and so does their entity, which makes every repeat one link away from it.
Loopy message passing spreads labels until they settle, and another node whose label is sure enough becomes a span too: a
number written with a ``+`` once is a phone number wherever the document repeats it.

The weights are fitted by pseudo-likelihood to the rules' own labels on about ``sample`` documents with
nodes (by a hash of the id), the first ``FIT_NODES`` nodes of each, where a node is linked to the one before of its form.
Finding reads whole texts. There are at most four links a node whatever the document, so a sweep costs as much as nodes.

Positions count code points; ends are exclusive. Edge cases: a null text counts as empty; repeated
rows are each scanned; without nodes to learn from only the rules speak; an empty table gives an empty
result; extra columns are ignored, or kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import parts

#: The kinds in the order of spans with one start.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Repeats are possessive where giving back could not help, so that long runs cost no more than their length.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])*+")
DIGITS = re.compile(r"[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]++")

SAMPLE = 20_000
FIT_NODES = 64
MIN_DIGITS = 7
NEAR = 200
TAIL = 7
SURE = 0.9
#: Sweeps end when messages settle; this only ends those that never do.
ROUNDS = 1000
CHAIN, SAME, SIMILAR = range(3)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping: per at sign the local part reaches as far back as it can."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            free = domain.end()
            out.append((start, free))
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of kind, end) of what the rules find, in order."""
    out = [(s, 0, e) for s, e in emails(text)]
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if m[1] and all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() > 11 and 12 <= len(d := NOT_DIGITS.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def nodes(text: str) -> list[tuple[int, int]]:
    """Stretches that could be personal data: round an at sign, or with ``MIN_DIGITS`` digits and no letter beside."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        while end < len(text) and text[end] in LOCAL_PART:
            end += 1
        if start < at and end > at + 1:
            out.append((start, end))
            free = end
        at = text.find("@", end)
    if DIGITS.search(text):
        for m in NUMBER.finditer(text):
            start, end = m.span()
            if end - start < MIN_DIGITS or len(DIGITS.findall(m[0])) < MIN_DIGITS:
                continue
            beside = text[start - 1 : start] + text[end : end + 1]
            if not any(c.isalnum() or c in "_@" for c in beside):
                out.append((start, end))
    return sorted(out)


#: Yes-or-no features of a node besides its number of digits.
N_COUNTS = 24
N_FEATURES = N_COUNTS + 10


def features(node: str) -> list[int]:
    digits = NOT_DIGITS.sub("", node)
    groups = len(NOT_DIGITS.sub(" ", node).split())
    has = ["@" in node, node[0] == "+", "(" in node, node.count(".") == 3, "." in node, "-" in node, " " in node, groups == 4]
    domain = node.rpartition("@")[2]
    has += [bool(DOMAIN.fullmatch(domain)) and "@" in node, not digits]
    return [min(len(digits), N_COUNTS - 1), *[N_COUNTS + i for i, yes in enumerate(has) if yes]]


def forms(node: str) -> tuple[str, str]:
    """Normal form, and the rough one that similar nodes share."""
    node = node.lower()
    digits = NOT_DIGITS.sub("", node)
    return (node, node.partition("@")[0]) if "@" in node else (digits, digits[-TAIL:])


def neighbours(found: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    return [(i - 1, i, CHAIN) for i in range(1, len(found)) if found[i][0] - found[i - 1][1] <= NEAR]


def links(text: str, found: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(node, later node, kind of link) to fit by: neighbours, and the next node of the same or a similar normal form."""
    out = neighbours(found)
    same: dict[str, int] = {}
    similar: dict[str, int] = {}
    for i, (start, end) in enumerate(found):
        form, rough = forms(text[start:end])
        if form in same:
            out.append((same[form], i, SAME))
        elif rough in similar:
            out.append((similar[rough], i, SIMILAR))
        same[form] = similar[rough] = i
    return out


def entities(text: str, found: list[tuple[int, int]]) -> tuple[list[tuple[int, int, int]], list[list[int]]]:
    """(links to find by, nodes of each entity): entities are numbered after the nodes.

    All nodes of one form are linked to its entity; forms that share a rough form, to an entity of that.
    """
    same: dict[str, list[int]] = {}
    similar: dict[str, list[str]] = {}
    for i, (start, end) in enumerate(found):
        form, rough = forms(text[start:end])
        if form not in same:
            similar.setdefault(rough, []).append(form)
        same.setdefault(form, []).append(i)
    out, members, hub = neighbours(found), [], {}
    for form, of_form in same.items():
        hub[form] = of_form[0]
        if len(of_form) > 1:
            hub[form] = len(found) + len(members)
            members.append(of_form)
            out += [(i, hub[form], SAME) for i in of_form]
    for of_rough in similar.values():
        if len(of_rough) > 1:
            out += [(hub[form], len(found) + len(members), SIMILAR) for form in of_rough]
            members.append([i for form in of_rough for i in same[form]])
    return out, members


def labels_of(found: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """The label of the first rule span that overlaps each node, 0 if none does."""
    out, first = [], 0
    for start, end in found:
        while first < len(base) and base[first][0] < start and max(b[2] for b in base[first : first + 2]) <= start:
            first += 1
        out.append(next((k + 1 for s, k, e in base[first : first + 8] if s < end and e > start), 0))
    return out


class Field:
    """Unary weights by feature, chain weights by pair of labels, weights of agreement over skip links."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, agree: np.ndarray):
        self.unary, self.chain, self.agree = unary, chain, agree

    def between(self, kind: int) -> np.ndarray:
        return self.chain if kind == CHAIN else self.agree[kind] * np.eye(len(LABELS))

    def marginals(
        self, rows: list[list[int]], fixed: list[int], edges: list[tuple[int, int, int]], members: list[list[int]] | None = None
    ) -> np.ndarray:
        """Loopy sum-product until messages settle; nodes with a fixed label keep it.

        ``members`` has the nodes of each entity: it takes the labels fixed on them, in proportion where they differ.
        """
        members = members or []
        own = np.zeros((len(rows) + len(members), len(LABELS)))
        own[: len(rows)] = [self.unary[r].sum(0) for r in rows]
        for i, of in enumerate([*[[i] for i in range(len(rows))], *members]):
            known = [fixed[j] for j in of if fixed[j]]
            if known:
                own[i] = -30.0
                for label in set(known):
                    own[i, label] = np.log(known.count(label) / len(known))
        if not edges:
            return _softmax(own)
        a = np.array([e[0] for e in edges] + [e[1] for e in edges])
        b = np.array([e[1] for e in edges] + [e[0] for e in edges])
        pair = np.stack([self.between(e[2]) for e in edges] + [self.between(e[2]).T for e in edges])
        n = len(edges)
        back = np.r_[n : 2 * n, 0:n]
        messages = np.zeros((2 * n, len(LABELS)))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, b, messages)
            sent = belief[a] - messages[back]
            scores = sent[:, :, None] + pair
            top = scores.max(1, keepdims=True)
            fresh = np.log(np.exp(scores - top).sum(1)) + top[:, 0]
            fresh -= fresh.max(1, keepdims=True)
            moved = np.abs(fresh - messages).max()
            messages = 0.5 * (messages + fresh)
            if moved < 1e-3:
                break
        belief = own.copy()
        np.add.at(belief, b, messages)
        return _softmax(belief[: len(rows)])


def _softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def fit(examples: list[tuple[list[list[int]], list[int], list[list[int]]]], steps: int = 300, decay: float = 1e-3, rate: float = 0.05) -> Field:
    """Pseudo-likelihood: each node's label given its neighbours' labels. Agreement is drawn to 2 and 1, not to 0."""
    k = len(LABELS)
    rest = np.array([0.0, 2.0, 1.0])
    rows = [r for e in examples for r in e[0]]
    if not rows:
        return Field(np.zeros((N_FEATURES, k)), np.zeros((k, k)), rest)
    y = np.array([label for e in examples for label in e[1]])
    x = np.zeros((len(rows), N_FEATURES))
    for i, r in enumerate(rows):
        x[i, r] = 1.0
    heads = np.cumsum([0, *[len(e[1]) for e in examples]])
    edges = np.array([(h + i, h + j, kind) for h, e in zip(heads, examples, strict=False) for i, j, kind in e[2]]).reshape(-1, 3)
    hot = np.eye(k)[y]
    before, after = np.zeros_like(hot), np.zeros_like(hot)
    near = np.zeros((3, len(rows), k))
    for i, j, kind in edges:
        if kind == CHAIN:
            before[j] += hot[i]
            after[i] += hot[j]
        else:
            near[kind, i] += hot[j]
            near[kind, j] += hot[i]
    params = [np.zeros((N_FEATURES, k)), np.zeros((k, k)), rest.copy()]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        u, c, g = params
        miss = _softmax(x @ u + before @ c + after @ c.T + near[SAME] * g[SAME] + near[SIMILAR] * g[SIMILAR]) - hot
        miss /= len(rows)
        slopes = [
            x.T @ miss + decay * u,
            before.T @ miss + miss.T @ after + decay * c,
            np.array([0.0, (near[SAME] * miss).sum(), (near[SIMILAR] * miss).sum()]) + 10 * decay * (g - rest),
        ]
        for p, m, s, d in zip(params, first, second, slopes, strict=True):
            m += 0.1 * (d - m)
            s += 0.001 * (d * d - s)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Field(*params)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field:
    """The field fitted to a bounded sample of the documents."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(source):
            out = []
            for text in batch.column("text").to_pylist():
                if text and (found := nodes(text)[:FIT_NODES]):
                    spans = labels_of(found, base_spans(text))
                    out.append(([features(text[s:e]) for s, e in found], spans, [list(x) for x in links(text, found)]))
            names = ["rows", "labels", "links"]
            kinds = [pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=names)

    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2**30)) / 2**30
    some = docs.where(F.col(text_col).rlike("[0-9]{2}|@"))
    n = some.count()
    drawn = some.where(draw < sample / max(n, 1)).select(F.col(text_col).alias("text"))
    rows = drawn.mapInArrow(batches, "rows array<array<int>>, labels array<int>, links array<array<int>>").limit(2 * sample).collect()
    return fit(sorted((r["rows"], r["labels"], r["links"]) for r in rows))


def spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(rule spans, further spans), each (start, place of kind, end) in order."""
    base = base_spans(text)
    found = nodes(text)
    if not found:
        return base, []
    fixed = labels_of(found, base)
    if all(fixed):
        return base, []
    sure = field.marginals([features(text[s:e]) for s, e in found], fixed, *entities(text, found))
    best = sure.argmax(1)
    more = [
        (s, int(best[i]) - 1, e) for i, (s, e) in enumerate(found) if not fixed[i] and best[i] and sure[i, best[i]] >= SURE
    ]
    return base, more


def shown(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


def scan(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the rules' spans, their digest, all spans, n_added."""
    field = field or learn(docs, id_col, text_col)
    counts = [f"n_{kind}" for kind in KINDS]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(source):
            rows = [spans(text or "", field) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([sum(k == i for _, k, _ in base) for base, _ in rows], pa.int64()) for i in range(len(KINDS))],
                    pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                    pa.array([shown(base + more) for base, more in rows], pa.string()),
                    pa.array([len(more) for _, more in rows], pa.int64()),
                ],
                names=["doc_id", *counts, "base_sha256", "spans", "n_added"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    longs = ", ".join(f"{c} bigint" for c in counts)
    return rows.mapInArrow(batches, f"doc_id bigint, {longs}, base_sha256 string, spans string, n_added bigint")


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """``text`` with each span (overlapping ones as one) replaced by its kind in angle brackets."""
    out, at = [], 0
    for start, kind, end in sorted(found):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in its text replaced; a text without spans stays as it is."""
    field = field or learn(docs, text_col=text_col)

    place = docs.columns.index(text_col)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(source):
            texts = batch.column(place).to_pylist()
            clean = [None if t is None else masked(t, [*(both := spans(t, field))[0], *both[1]]) for t in texts]
            yield batch.set_column(place, text_col, pa.array(clean, pa.string()))

    return docs.mapInArrow(batches, docs.schema)
