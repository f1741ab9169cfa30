"""Personal data: patterns, then a skip-chain conditional random field that finds what they miss.

The patterns (email, ip, card, phone) give the base spans, which always stay. Nodes of the field are the base spans and
candidates: written-out or defanged addresses, numbers in groups without a country code, long numbers that fail their check.
Each has a kind that it may be, and a shape from which what makes a pattern match (the plus and country code, the check
digit, the @ or the full stops) is masked. So counts of shapes, with or without a cue word before, say how often such a
token is personal data where the patterns can tell, and that carries over to candidates of the same shape. Nodes that
follow one another closely share a chain potential; similar nodes (the same address or local part, the same last seven
digits, one digit changed) share a skip potential, however far apart, each linked to the last with that trait. Base spans
are held at their label; loopy sum-product messages run over every document with a candidate, and a candidate that is sure
enough becomes an added span.

Potentials are learnt from counts over every document, summed by Spark: shares of shapes, and what a neighbour's label adds
to them, by pseudo-likelihood. Shapes are bounded, so the counts are a table of bounded size. A text with more nodes than WINDOW is inferred stretch by stretch, links back into an
earlier stretch being messages from its beliefs, so memory per text stays bounded beside the text and its nodes. Candidates
that overlap a base span or an earlier candidate are left out; of equal starts the first kind listed wins. Null text counts
as empty; repeated rows get equal spans; other columns are left out; an empty table gives no rows. No row moves between tasks.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.llm.common import documents, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0: none
SURE, STEPS, WINDOW, UNLABELLED = 0.9, 12, 4096, 0.05
#: Log odds by which two numbers that share seven digits, or two equal addresses, have the same label before the table tells.
SAME = 10.0
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
DIGITS = re.compile(r"[^0-9]+")
#: What may stand for an @ or a full stop in a written-out address.
AT = re.compile(r"@| ?[(\[{] ?(?:at|AT) ?[)\]}] ?| (?:at|AT) ")
BRACKETED = re.compile(r"[(\[{] ?(?:at|AT) ?[)\]}] ?")
RUN = re.compile(r"[0-9]+")
DOT = r"(?:\.| ?[(\[{] ?(?:\.|dot|DOT) ?[)\]}] ?| (?:dot|DOT) )"
ENDS_IN_DOT = re.compile(r"[(\[{] ?(?:\.|dot|DOT) ?[)\]}]\Z")
WRITTEN = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}")
#: Candidates by kind, among digits.
NUMERIC = {
    "ip": re.compile(r"(?<![0-9.-])[0-9]{1,3}(?:(?:-|" + DOT[3:-1].replace(r"\.|", "", 1) + r")[0-9]{1,3}){3}(?![0-9-])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]{1,2}[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])|(?<![0-9.])[0-9]{7,12}(?![0-9.])"),
}
#: Words that announce each kind.
CUES = {"email": ("mail", "email", "write", "contact"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "pay"), "phone": ("tel", "phone", "telephone", "call", "fax", "mobile", "ring")}
WORD = re.compile(r"[A-Za-z]+")
#: Last labels of addresses that count by name.
LAST_LABELS = frozenset("com org net edu gov mil int info biz io co me eu de fr es it nl uk us ch at be pl ru cn jp br in test example invalid".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from each @, so that long runs of local-part letters are read once."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, end))
        last = end
        at = text.find("@", end)
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Four parts each, left to right along every dotted chain of numbers."""
    out = []
    for m in NUMBERS.finditer(text):
        if m.group().count(".") < 3:
            continue
        at = m.start()
        parts = m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in four):
                out.append((at, end))
            at = end + 1
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """By kind as listed, then by start; offsets in code points."""
    if not MARK.search(text):
        return [[], [], [], []]
    cards = []
    for m in CARD.finditer(text):
        digits = DIGITS.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            cards.append(m.span())
    phones = []
    if "+" in text:
        phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(DIGITS.sub("", m.group())) <= 15]
    return [emails(text), addresses(text), cards, phones]


def ats(text: str) -> list[tuple[int, int]]:
    """Where an @ is, or what may stand for it."""
    out = []
    for mark in ("@", " at ", " AT "):
        at = text.find(mark)
        while at >= 0:
            out.append((at, at + len(mark)))
            at = text.find(mark, at + 1)
    if "at" in text or "AT" in text:
        out += [(m.start() - (text[m.start() - 1 : m.start()] == " "), m.end()) for m in BRACKETED.finditer(text)]
    return sorted(out)


def written(text: str) -> list[tuple[int, int]]:
    """Addresses with something in place of the @ or of full stops."""
    out = []
    for at, end in ats(text):
        start, least = at, max(0, at - 64)
        while True:
            while start > least and text[start - 1] in LOCAL:
                start -= 1
            dot = ENDS_IN_DOT.search(text, max(least, start - 7), start) if start < at else None
            if dot is None or dot.start() <= least or text[dot.start() - 1] not in LOCAL:
                break
            start = dot.start()
        if start == at or not (d := WRITTEN.match(text, end)):
            continue
        plain = text[at] == " " and text[at + 1] in "aA" and text[start:at].isalpha() and not re.search("dot|DOT|[(\\[{]", d.group())
        if not plain:  # "look at example.com" is prose
            out.append((start, d.end()))
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Where digits are, with what may belong to their number."""
    out: list[tuple[int, int]] = []
    for m in RUN.finditer(text):
        if out and m.start() - out[-1][1] <= 8:
            out[-1] = (out[-1][0], m.end())
        else:
            out.append((max(0, m.start() - 2), m.end()))
    return out


def nodes_of(text: str, spans: list[list[tuple[int, int]]]) -> list[tuple[int, int, int, bool]]:
    """(start, end, kind from 1, whether a base span) in text order, none overlapping a base span of its own or another kind
    but base spans themselves."""
    base = sorted((a, b, k, True) for k, found in enumerate(spans, 1) for a, b in found)
    free = []
    free += [(a, b, 1, False) for a, b in written(text)]
    for begin, end in stretches(text):
        if end - begin >= 7:
            for kind, pattern in NUMERIC.items():
                found = (m for m in pattern.finditer(text, begin, end) if kind != "ip" or all(int(x) <= 255 for x in RUN.findall(m.group())))
                free += [(*m.span(), KINDS.index(kind) + 1, False) for m in found]
    free.sort(key=lambda x: (x[0], x[2]))
    ends = np.maximum.accumulate([b for _, b, _, _ in base]) if base else np.zeros(0)
    starts = [a for a, _, _, _ in base]
    out, last = [], 0
    for x in free:
        at = int(np.searchsorted(ends, x[0], "right"))  # the first base span that ends after the candidate's start
        if x[0] >= last and (at == len(base) or starts[at] >= x[1]):
            out.append(x)
            last = x[1]
    return sorted(base + out)


def core(token: str, kind: int) -> str:
    """An address in lower case, the digits of a number; equal for tokens that mean the same."""
    if kind != 1:
        return DIGITS.sub("", token)
    local, _, domain = AT.sub("@", token.lower(), count=1).partition("@")
    return f"{re.sub(DOT, '.', local)}@{re.sub(DOT, '.', domain)}"


def shape(token: str, kind: int) -> str:
    """How a token is built, without what only a matching pattern has. A few thousand shapes at most: a last label that isn't
    listed counts by its length, groups of digits by their number, the lengths of the first four and the length of all."""
    if kind == 1:
        local, _, domain = core(token, 1).partition("@")
        last = domain.rpartition(".")[2]
        return "email " + "".join(c for c in "._%+-9" if c in re.sub("[0-9]", "9", local)) + f" {min(domain.count('.'), 4)} " + (last if last in LAST_LABELS else str(min(len(last), 8)))
    if kind == 2:
        return "ip -" if "-" in token else "ip"
    groups = [len(g) for g in RUN.findall(token)]
    if token.startswith("+") and len(groups) > 1:
        groups = groups[1:]
    more = f" {len(groups)} {min(sum(groups), 20)}" if len(groups) > 4 else ""
    return f"{KINDS[kind - 1]} {'-'.join(str(min(g, 20 if len(groups) == 1 else 8)) for g in groups[:4])}{more}"


def cue(text: str, start: int, kind: int) -> bool:
    """Whether one of the last words in 24 code points before announces the kind."""
    mine = CUES[KINDS[kind - 1]]
    return any(w.lower() in mine for w in WORD.findall(text[max(0, start - 24) : start]))


def traits(token: str, kind: int) -> list[str]:
    """Nodes that share one are similar."""
    c = core(token, kind)
    if kind == 1:
        return [c, c.partition("@")[0] + "@"]
    if kind == 2:
        return ["ip" + ".".join(RUN.findall(token))]
    if len(c) < 7:
        return []
    return [c[-7:], *(f"{c[:i]}?{c[i + 1 :]}" for i in range(len(c) if len(c) >= 10 else 0))]


def described(text: str, nodes: list[tuple[int, int, int, bool]]) -> tuple[list[str], list[tuple[int, int]], list[tuple[int, int]]]:
    """Of each node the key of its unary potential; chain links (40 code points apart at most); skip links, earlier node first."""
    passed = [k == 3 and not held and luhn(core(text[a:b], k)) for a, b, k, held in nodes]  # only a neighbour spoilt the match
    keys = [shape(text[a:b], k) + " cue" * cue(text, a, k) + " ok" * y for (a, b, k, _), y in zip(nodes, passed, strict=True)]
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][0] - nodes[i][1] <= 40]
    last: dict[str, int] = {}
    skip = []
    for i, (a, b, k, _) in enumerate(nodes):
        mine = traits(text[a:b], k)
        skip += [(j, i) for j in sorted({last[t] for t in mine if t in last})]
        last.update(dict.fromkeys(mine, i))
    return keys, chain, skip


def count(text: str, counts: Counter, field: Field | None = None) -> None:
    """Adds a document's (piece, key, label, neighbour's label) to counts: of nodes; with a field, of its links instead, where
    a candidate has a label if the field is sure of it."""
    nodes = nodes_of(text, base_spans(text))
    if not nodes:
        return
    keys, chain, skip = described(text, nodes)
    labels = [k if held else 0 for _, _, k, held in nodes]
    if field is None:
        for key, y in zip(keys, labels, strict=True):
            # a shape counts with and without its cue; a held card also as one that passes its check, while free ones that pass
            # it were only spoilt by a neighbour, so they say nothing
            for k in {key, key.replace(" cue", "")} if not key.endswith(" ok") else ():
                counts["node", k, y, 0] += 1
                if y == 3:
                    counts["node", k + " ok", y, 0] += 1
    elif chain or skip:
        belief = field.marginals(text, nodes)
        likely = [k if held or p[k] >= SURE else 0 for (_, _, k, held), p in zip(nodes, belief, strict=True)]
        for name, pairs in (("chain", chain), ("skip", skip)):
            for i, j in (*pairs, *((j, i) for i, j in pairs)):
                counts[name, keys[j].removesuffix(" ok"), likely[j], likely[i]] += 1


def against(key: str) -> float:
    """How much a node without a label speaks against its shape. A number that fails its check digit is no card, and plain
    digits are mostly something else, so these count whole. Other candidates look as they do because someone wrote the
    thing so; they are unlabelled rather than wrong, and count little."""
    kind, _, groups = key.removesuffix(" cue").partition(" ")
    return 1.0 if kind == "card" or kind == "phone" and groups.isdigit() else UNLABELLED


def learnt(odds: np.ndarray, sign: np.ndarray, yes: np.ndarray, no: np.ndarray, usual: float, spread: float) -> float:
    """The weight that, added or taken off by sign, best explains labels beside what shapes say: logistic with the shapes' log
    odds as offsets, by Newton steps. Where few nodes tell, it stays near what is usual (a normal prior of that spread)."""
    w = usual
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(odds + sign * w, -40, 40)))
        slope = (sign * (yes - (yes + no) * p)).sum() - (w - usual) / spread**2
        step = slope / (((yes + no) * p * (1 - p)).sum() + 1 / spread**2)
        w += float(np.clip(step, -1, 1))
        if abs(step) < 1e-6:
            break
    return w


class Field:
    """Potentials from counts, and inference in one document.

    Unary potentials are the shares of a shape. A pair potential is 0 where both labels are the same, also none, and -s where
    one is kind k and the other none: a neighbour of that kind adds s to the log odds of k, one without a label takes s off, so
    nodes that are both unsure don't lift each other. s is learnt from all linked nodes, given what their shapes say. Before any is
    seen it is SAME for similar nodes, and 0 for neighbours in text. Two kinds that differ repel by the mean of theirs.
    """

    def __init__(self, rows: list[tuple[str, str, int, int, int]]):
        self.share: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(2))  # of a key: nodes without a label, and with one
        seen: dict[tuple[str, int], dict[tuple[str, int], np.ndarray]] = defaultdict(lambda: defaultdict(lambda: np.zeros(2)))
        for piece, key, y, z, n in rows:
            kind = KINDS.index(key.partition(" ")[0]) + 1 if key.partition(" ")[0] in KINDS else 0
            if piece == "node":
                self.share[key][int(y > 0)] += n * (1.0 if y else against(key))
            elif kind and z in (0, kind):
                seen[piece, kind][key, 1 if z else -1][int(y > 0)] += n
        self.skip = self.table(SAME, 1.0, [seen["skip", k] for k in range(1, LABELS)])
        self.chain = self.table(0.0, 0.25, [seen["chain", k] for k in range(1, LABELS)])

    def table(self, usual: float, spread: float, seen: list[dict[tuple[str, int], np.ndarray]]) -> np.ndarray:
        s = np.zeros(LABELS)
        for k, counts in enumerate(seen, 1):
            odds = np.array([np.subtract(*self.unary(key, k)[[k, 0]]) for key, _ in counts])
            no, yes = np.array(list(counts.values())).reshape(-1, 2).T
            s[k] = learnt(odds, np.array([sign for _, sign in counts], float), yes, no, usual, spread)
        out = -(s[:, None] + s[None, :]) / 2
        out[0, :], out[:, 0] = -s, -s
        np.fill_diagonal(out, 0.0)
        return out

    def unary(self, key: str, kind: int) -> np.ndarray:
        """Log potentials: none, or the kind that the node may be. A shape that was never seen has one chance in ten."""
        free, held = self.share.get(key, self.share.get(key.replace(" cue", ""), (0, 0)))
        out = np.full(LABELS, -50.0)
        out[0], out[kind] = np.log(free + 1.8), np.log(held + 0.2)
        return out

    def beliefs(self, local: np.ndarray, chain: list[tuple[int, int]], skip: list[tuple[int, int]]) -> np.ndarray:
        """Marginals of each node's label by loopy belief propagation."""
        pairs = np.array([*chain, *skip], np.int64).reshape(-1, 2)
        which = np.repeat([0, 1], [len(chain), len(skip)])
        tables = np.stack([self.chain, self.skip])
        src, dst = np.concatenate((pairs[:, 0], pairs[:, 1])), np.concatenate((pairs[:, 1], pairs[:, 0]))
        table = np.concatenate((tables[which], tables.transpose(0, 2, 1)[which]))  # [link, label of src, label of dst]
        back = np.concatenate((np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))))
        messages = np.zeros((len(src), LABELS))
        for _ in range(STEPS if len(pairs) else 0):
            total = local.copy()
            np.add.at(total, dst, messages)
            sent = (total[src] - messages[back])[:, :, None] + table
            top = sent.max(axis=1, keepdims=True)
            new = np.log(np.exp(sent - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - messages).max(initial=0.0)
            messages = 0.5 * messages + 0.5 * new
            if moved < 1e-4:
                break
        total = local.copy()
        np.add.at(total, dst, messages)
        p = np.exp(total - total.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def marginals(self, text: str, nodes: list[tuple[int, int, int, bool]], window: int = WINDOW) -> np.ndarray:
        """Beliefs of all nodes, stretch by stretch."""
        keys, chain, skip = described(text, nodes)
        local = np.array([self.unary(key, k) for key, (_, _, k, _) in zip(keys, nodes, strict=True)])
        for i, (_, _, k, held) in enumerate(nodes):
            if held:
                local[i] = -50.0
                local[i, k] = 0.0
        out = np.zeros_like(local)
        ahead = {"chain": 0, "skip": 0}
        for begin in range(0, len(nodes), window):
            end = min(len(nodes), begin + window)
            mine: dict[str, list[tuple[int, int]]] = {"chain": [], "skip": []}
            for name, links, table in (("chain", chain, self.chain), ("skip", skip, self.skip)):
                at = ahead[name]
                while at < len(links) and links[at][1] < end:
                    i, j = links[at]
                    if i >= begin:
                        mine[name].append((i - begin, j - begin))
                    else:  # the other end is settled
                        local[j] += np.log(out[i] @ np.exp(table))
                    at += 1
                ahead[name] = at
            out[begin:end] = self.beliefs(local[begin:end], mine["chain"], mine["skip"])
        return out

    def added(self, text: str, spans: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
        out: list[list[tuple[int, int]]] = [[] for _ in KINDS]
        nodes = nodes_of(text, spans)
        if all(held for *_, held in nodes):
            return out
        p = self.marginals(text, nodes)
        for (a, b, k, held), mine in zip(nodes, p, strict=True):
            if not held and mine[k] >= SURE:
                out[k - 1].append((a, b))
        return out


def fit(docs: DataFrame, text: str = "text") -> list[tuple[str, str, int, int, int]]:
    """The field's counts over every document, rows by shape, label and neighbour's label of a bounded number: first of nodes,
    then of links, candidates having the labels that the field of the first counts is sure of."""
    schema = pa.schema([("piece", pa.string()), ("key", pa.string()), ("y", pa.int64()), ("z", pa.int64()), ("n", pa.int64())])

    def summed(known: list[tuple] | None) -> list[tuple[str, str, int, int, int]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            field = Field(known) if known is not None else None
            for batch in slices(batches, text, 4 << 20):
                for t in batch.column(0).to_pylist():
                    if t:
                        count(t, counts, field)
            yield pa.RecordBatch.from_pylist([dict(zip(("piece", "key", "y", "z", "n"), (*k, n), strict=True)) for k, n in counts.items()], schema=schema)

        found = docs.select(text).mapInArrow(run, "piece string, key string, y long, z long, n long")
        return [tuple(r) for r in found.groupBy("piece", "key", "y", "z").agg(F.sum("n").alias("n")).orderBy("piece", "key", "y", "z").collect()]

    nodes = summed(None)
    return nodes + summed(nodes)


def listed(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, found in zip(KINDS, spans, strict=True) for a, b in found)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base (spans, listed), spans (all, listed), n_added, n_spans."""
    rows = fit(docs, text)
    names = [*[f"n_{k}" for k in KINDS], "base", "spans", "n_added", "n_spans"]
    kinds = [T.LongType()] * 4 + [T.StringType()] * 2 + [T.LongType()] * 2
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(n, t) for n, t in zip(names, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(rows)
        for batch in slices(batches, text, 4 << 20):
            found = []
            for t in batch.column(text).to_pylist():
                spans = base_spans(t or "")
                more = field.added(t or "", spans)
                both = [sorted(a + b) for a, b in zip(spans, more, strict=True)]
                found.append((*map(len, spans), listed(spans), listed(both), sum(map(len, more)), sum(map(len, both))))
            columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=schema.names)

    return docs.select("doc_id", text).mapInArrow(run, schema)


def redact(text: str, spans: str) -> str:
    """The text with each listed span replaced by its kind in angle brackets; of overlapping spans, the first."""
    cuts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for a, b, k in cuts:
        if a >= at:
            out += [text[at:a], f"<{k}>"]
            at = b
    return "".join([*out, text[at:]])


def op1_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added", "n_spans")
