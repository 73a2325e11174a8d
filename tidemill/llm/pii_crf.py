"""Personal data by fixed rules and a skip-chain conditional random field.

The rules find the base spans (e-mail, IP, card and phone numbers); their tokens are
observed.  The field then labels the other tokens that hold a digit or an at sign: numbers
and addresses that the rules cannot see, as their plus, their separators or their at sign
are gone or written otherwise.  Its potentials are

* unary: the token's shape, its place in a run of numbers, the words around it,
* chain: between tokens that follow each other closely,
* skip: between tokens anywhere in the document with the same letters and digits (EQUAL), or
  whose numbers end in the same digits or whose addresses have the same name (SIMILAR).

Loopy belief propagation runs until no message moves by more than ``TOLERANCE``, over all
edges of a batch of documents at once, so a label that one mention makes certain reaches
every mention of the document.  A group of n equal tokens has n - 1 skip edges, all from
its first observed token (else its first), so evidence takes two steps however often a
token repeats.  Tokens that hold neither a digit nor an at sign can be no entity: they are
observed as outside and enter as context.

Tokens are runs of characters that mentions are written with, of any length; others, as
quotes, slashes and all beyond ASCII, lie between tokens.

The field is fitted by pseudo-likelihood, all potentials together, on at most ``FIT_DOCS``
documents (those with the smallest hash of the id; a documented bound), of each a passage of
``FIT_WORDS`` words at a place chosen by hash.  Labels that the rules cannot give come from
mentions put into these passages: some repeat a mention of the rules' form in another form,
some stand beside a word that names their kind, and some are numbers of the same looks that
are no personal data.  Every document is labelled over its whole text.

Defined results: null text counts as empty; texts without spans give zero counts, the
digest of the empty string and empty spans; repeated rows give a row each; an empty
table gives an empty result; only the id and the text are read.  Offsets count code points.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, read_table, sha256_hex, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
FIT_DOCS = 6000
FIT_WORDS = 120
DIM = 1 << 13
TOLERANCE = 1e-3
MOST_ROUNDS = 200
SURE = 0.8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits is tried from its start only: what fails there fails from within it too
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ACTIVE = re.compile(r"[0-9@]|[\[(]at[\])]")
_TOKEN = re.compile(r"[A-Za-z0-9._%+@()\[\]-]+")
_AT = re.compile(r"@|[\[(]at[\])]")
_DOT = re.compile(r"[\[(](?:\.|dot)[\])]")
_FOUR = re.compile(r"[^0-9]*([0-9]{1,3})[^0-9]+([0-9]{1,3})[^0-9]+([0-9]{1,3})[^0-9]+([0-9]{1,3})[^0-9]*")
_EDGE_OF_ENTITY = re.compile(r"[A-Za-z0-9+(].*[A-Za-z0-9]|[A-Za-z0-9]", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern's leftmost matches, but in one walk over the at signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and then start."""
    out = []
    if "@" in text:
        out += [(0, a, z) for a, z in _emails(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                d = _digits(m.group())
                if 13 <= len(d) <= 19 and luhn(d):
                    out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_SHAPE = str.maketrans({**{ch: "d" for ch in "0123456789"}, **{ch: "a" for ch in "abcdefghijklmnopqrstuvwxyz"}, **{ch: "A" for ch in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}})


def _shape(token: str) -> str:
    return token.translate(_SHAPE)


def _collapsed(shape: str) -> str:
    return re.sub(r"(.)\1+", r"\1+", shape)


@dataclass
class Graph:
    """The active tokens of one document, their observed labels (-1: hidden), and the edges between them (from, to, type)."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    edges: list[tuple[int, int, int]]
    observed: list[int]


CHAIN, EQUAL, SIMILAR = 0, 1, 2
#: Characters between two tokens of one run of numbers.
NEAR = 2


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph | None:
    if not _ACTIVE.search(text):
        return None
    spans, places, before, after = [], [], [], []
    words = ["", ""]
    for place, m in enumerate(_TOKEN.finditer(text)):
        token = m.group()
        if after and after[-1] is None:
            after[-1] = token[:24].lower().strip(".()")
        if _ACTIVE.search(token):
            spans.append(m.span())
            places.append(place)
            before.append(tuple(words))
            after.append(None)
        else:
            words = [words[1], token[-24:].lower().strip(".()")]
    if not spans:
        return None
    tokens = [text[a:z] for a, z in spans]
    shapes = [_shape(t) for t in tokens]
    observed = labels_of(spans, base)
    n = len(spans)
    joined = [i > 0 and places[i - 1] == places[i] - 1 and spans[i][0] - spans[i - 1][1] <= NEAR for i in range(n)] + [False]
    features, edges = [], [(i - 1, i, CHAIN) for i in range(1, n) if joined[i]]
    equal: dict[str, list[int]] = {}
    similar: dict[str, list[int]] = {}
    start = 0
    for i in range(n):
        if not joined[i] or not (_is_number(shapes[i]) and _is_number(shapes[i - 1])):
            start = i
        if i + 1 < n and joined[i + 1] and _is_number(shapes[i]) and _is_number(shapes[i + 1]):
            continue  # the run goes on
        run = range(start, i + 1)
        digits = _digits("".join(tokens[k] for k in run))
        whole = _collapsed(" ".join(shapes[k] for k in run)) if len(run) < 8 else "long"
        count, sound = min(len(digits), 24), 13 <= len(digits) <= 19 and luhn(digits)
        for k in run:
            t, s = tokens[k], shapes[k]
            names = [
                "bias",
                "s:" + s,
                "c:" + _collapsed(s),
                "r:" + whole,
                f"d:{count}",
                f"l:{sound}:{count}",
                f"at:{bool(_AT.search(t))}:{'.' in t}:{'a' in s}",
                f"k:{min(k - start, 3)}:{min(i - k, 3)}",
                "plus:" + str(t.startswith("+")),
                "w:" + before[k][1],
                "v:" + before[k][0],
                "n:" + (after[k] or ""),
            ]
            features.append([zlib.crc32(x.encode("utf-8", "replace")) % DIM for x in names])
            key = _key(t)
            if key:
                equal.setdefault(key, []).append(k)
            at = _AT.search(t)
            if at and at.start() >= 4:
                similar.setdefault(t[: at.start()].lower(), []).append(k)
        if len(digits) >= 9:
            similar.setdefault(digits[-8:], []).append(i)
    pairs = set()
    for kind, groups in ((EQUAL, equal), (SIMILAR, similar)):
        for members in groups.values():
            if len(members) > 1:
                hub = next((k for k in members if observed[k] > 0), members[0])
                for k in members:
                    pair = (min(hub, k), max(hub, k))
                    if k != hub and pair not in pairs and observed[k] <= 0:
                        pairs.add(pair)
                        edges.append((*pair, kind))
    return Graph(spans, features, edges, observed)


def _is_number(shape: str) -> bool:
    return "d" in shape and "a" not in shape and "A" not in shape and "@" not in shape


def _key(token: str) -> str:
    """What equal mentions share: four numbers of an address in order, else letters and digits; empty where that is too short."""
    four = _FOUR.fullmatch(token)
    if four:
        return ".".join(four.groups())
    key = "".join(ch for ch in _DOT.sub("", _AT.sub("", token)).lower() if ch.isalnum())
    return key if len(key) >= (5 if _AT.search(token) else 6) else ""


def labels_of(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """For each token 1 + the kind of the base span that it overlaps (where several do, the first listed), else -1."""
    out = [-1] * len(spans)
    ends = [e for _, e in spans]
    for kind, a, z in reversed(base):
        i = bisect_right(ends, a)
        while i < len(ends) and spans[i][0] < z:
            out[i] = kind + 1
            i += 1
    return out


@dataclass(frozen=True)
class Field:
    """unary: DIM x labels; pairs: for each edge type the log potentials, labels x labels, symmetric."""

    unary: np.ndarray
    pairs: np.ndarray

    def beliefs(self, graphs: list[Graph]) -> np.ndarray:
        """Label probabilities of all tokens of all graphs, by loopy belief propagation until messages rest."""
        n_features = len(graphs[0].features[0])
        ids = np.array([f for g in graphs for f in g.features]).reshape(-1, n_features)
        own = self.unary[ids].sum(axis=1)
        observed = np.array([v for g in graphs for v in g.observed])
        (known,) = np.nonzero(observed >= 0)
        own[known] = -60.0
        own[known, observed[known]] = 0.0
        edges, base = [], 0
        for g in graphs:
            edges += [(a + base, b + base, k) for a, b, k in g.edges]
            base += len(g.spans)
        if edges:
            e = np.array(edges)
            src, dst = np.concatenate([e[:, 0], e[:, 1]]), np.concatenate([e[:, 1], e[:, 0]])
            psi = np.concatenate([self.pairs[e[:, 2]], self.pairs[e[:, 2]].transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(e)) + len(e), np.arange(len(e))])
            messages = np.zeros((len(src), len(LABELS)))
            for _ in range(MOST_ROUNDS):
                belief = own.copy()
                np.add.at(belief, dst, messages)
                new = _log_sum(belief[src][:, :, None] - messages[back][:, :, None] + psi, 1)
                new -= _log_sum(new, 1)[:, None]
                moved = np.abs(new - messages).max()
                messages = 0.3 * messages + 0.7 * new
                if moved < TOLERANCE:
                    break
            np.add.at(own, dst, messages)
        own -= own.max(axis=1, keepdims=True)
        p = np.exp(own)
        return p / p.sum(axis=1, keepdims=True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def fit(examples: list[tuple[list[list[int]], list[int], list[int], list[tuple[int, int, int]]]], steps: int = 150) -> Field:
    """All potentials by pseudo-likelihood: every hidden token's label given its features and its neighbours' labels.

    examples: features, labels, observed labels and edges of each passage.
    """
    n_labels = len(LABELS)
    unary, pairs = np.zeros((DIM, n_labels)), np.zeros((3, n_labels, n_labels))
    y = np.array([v for _, labels, _, _ in examples for v in labels], dtype=int)
    hidden = np.array([v < 0 for _, _, seen, _ in examples for v in seen], dtype=bool)
    if not hidden.any():
        unary[zlib.crc32(b"bias") % DIM, 0] = 5.0
        return Field(unary, pairs)
    near, base = np.zeros((3, len(y), n_labels)), 0
    for _, labels, _, edges in examples:
        for a, b, k in edges:
            near[k, base + a, labels[b]] += 1
            near[k, base + b, labels[a]] += 1
        base += len(labels)
    ids = np.array([f for x, _, _, _ in examples for f in x])[hidden]
    near, target = near[:, hidden], np.eye(n_labels)[y[hidden]]
    n, width = ids.shape
    flat = ids.ravel()
    power, power2 = np.full(unary.shape, 1e-2), np.full(pairs.shape, 1e-2)
    for _ in range(steps):
        z = unary[ids].sum(axis=1) + sum(near[k] @ pairs[k] for k in range(3))
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) / n * 50
        step = np.stack([np.bincount(flat, weights=np.repeat(error[:, k], width), minlength=DIM) for k in range(n_labels)], axis=1) + 3e-3 * unary
        step2 = np.stack([near[k].T @ error for k in range(3)])
        step2 = (step2 + step2.transpose(0, 2, 1)) / 2 + 3e-3 * pairs
        power += step**2
        power2 += step2**2
        unary -= 0.3 * step / np.sqrt(power)
        pairs -= 0.3 * step2 / np.sqrt(power2)
    return Field(unary, pairs)


#: Words that name a kind, for passages of the fit.
CUES = (
    ("mail", "email", "e-mail", "contact", "write", "correo", "courriel"),
    ("ip", "host", "address", "server", "login"),
    ("card", "visa", "credit", "tarjeta", "carte", "karte"),
    ("phone", "tel", "call", "mobile", "telefon", "fax"),
)


def _mention(rng: random.Random, kind: int) -> tuple[str, list[str]]:
    """A made-up mention of the rules' form, and the same in forms that the rules do not find."""
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == 0:
        name = "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(4, 9))) + rng.choice(["", ".", "_"]) + rng.choice(["", num(2), "lee", "kim"])
        host = "".join(rng.choice("abcdefghiklmnost") for _ in range(rng.randrange(4, 8)))
        name = name.rstrip("._")
        return f"{name}@{host}.com", [f"{name}[at]{host}.com", f"{name}(at){host}.com", f"{name}@{host}", f"{name}[at]{host}[dot]com"]
    if kind == 1:
        part = [str(rng.randrange(1, 256)) for _ in range(4)]
        return ".".join(part), ["-".join(part), "_".join(part), "[.]".join(part), "(.)".join(part)]
    if kind == 2:
        d = rng.choice("345") + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        four = [d[k : k + 4] for k in range(0, 16, 4)]
        return rng.choice([d, " ".join(four), "-".join(four)]), [".".join(four), "_".join(four), "  ".join(four), "/".join(four)]
    country, a, b, c = rng.choice(["1", "34", "49", "33"]), num(3), num(rng.choice([3, 4])), num(rng.choice([3, 4]))
    form = rng.choice([f"+{country} ({a}) {b}-{c}", f"+{country} {a}-{b}-{c}", f"+{country}{a}{b}{c}", f"+{country} {a} {b} {c}"])
    return form, [f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}{b}{c}", f"{a}.{b}.{c}", f"{country}-{a}-{b}-{c}", f"{a} {b} {c}"]


def _look_alike(rng: random.Random) -> str:
    """A number or address that looks like a mention and is none: an order, a version, a date, a card number that fails the check."""
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    form = rng.randrange(8)
    if form == 0:
        d = num(15)
        d += rng.choice([c for c in "0123456789" if not luhn(d + c)])
        return rng.choice([d, " ".join(d[k : k + 4] for k in range(0, 16, 4)), ".".join(d[k : k + 4] for k in range(0, 16, 4))])
    if form == 1:
        return ".".join(str(rng.randrange(256, 1000)) for _ in range(4))
    if form == 2:
        return f"{num(4)}-{num(2)}-{num(2)}"
    if form == 3:
        return rng.choice(["v", ""]) + f"{num(1)}.{num(2)}.{num(1)}"
    if form == 4:
        return f"@{rng.choice(['home', 'work', 'noon'])}"
    return rng.choice(_mention(rng, rng.choice([1, 3]))[1])  # a form of a mention, but alone and without a word that names its kind


def passage(text: str, seed: int) -> tuple[str, list[tuple[int, int, int]]]:
    """A passage of a text with made-up mentions put in, and where those are that the rules do not find: (kind, start, end)."""
    rng = random.Random(seed)
    words = text.split(" ")
    start = rng.randrange(max(1, len(words) - FIT_WORDS + 1))
    words = [("", w, -1) for w in words[start : start + FIT_WORDS]]

    def place(piece: str, kind: int = -1, before: str = "") -> None:
        words.insert(rng.randrange(len(words) + 1), (before, piece, kind))

    scene = rng.random()
    if scene < 0.45:
        for kind in rng.sample(range(4), rng.choice([1, 1, 2])):
            known, other = _mention(rng, kind)
            place(known)
            for _ in range(rng.choice([1, 1, 2, 3])):
                place(rng.choice(other), kind)
    elif scene < 0.6:
        kind = rng.randrange(4)
        other = rng.choice(_mention(rng, kind)[1])
        place(other, kind, before=rng.choice(CUES[kind]) + rng.choice([" ", ": "]))
    if rng.random() < 0.6:
        for _ in range(rng.choice([1, 2, 3])):
            alone = _look_alike(rng)
            for _ in range(rng.choice([1, 1, 2, 3])):  # what repeats is no mention for that
                place(alone)
    out, at, spans = [], 0, []
    for before, w, kind in words:
        at += len(before)
        if kind >= 0:
            spans.append((kind, at, at + len(w)))
        out.append(before + w)
        at += len(w) + 1
    return " ".join(out), spans


def example(text: str, seed: int) -> tuple[list[list[int]], list[int], list[int], list[tuple[int, int, int]]] | None:
    """Features, labels, observed labels and edges of a text's passage."""
    made, spans = passage(text, seed)
    base = base_spans(made)
    g = graph_of(made, base)
    if g is None:
        return None
    put = labels_of(g.spans, spans)
    return g.features, [o if o > 0 else max(p, 0) for o, p in zip(g.observed, put)], g.observed, g.edges


def train(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Field:
    rows = texts(docs)
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)

    def run(batches):
        for b in batches:
            out = {"x": [], "y": [], "o": [], "e": []}
            for i, t in zip(b["doc_id"], b["text"]):
                found = example(t, zlib.crc32(str(i).encode()))
                if found is not None:
                    out["x"].append([v for f in found[0] for v in f])
                    out["y"].append(found[1])
                    out["o"].append(found[2])
                    out["e"].append([v for e in found[3] for v in e])
            yield out

    got = arrow_map(rows.join(F.broadcast(chosen), "doc_id"), run, "x array<int>, y array<int>, o array<int>, e array<int>").collect()
    examples = []
    for r in sorted(got, key=lambda r: (r.y, r.x, r.o, r.e)):
        n = len(r.x) // max(1, len(r.y))
        examples.append(([r.x[i : i + n] for i in range(0, len(r.x), n)], r.y, r.o, [tuple(r.e[i : i + 3]) for i in range(0, len(r.e), 3)]))
    return fit(examples)


def added_spans(text: str, graph: Graph, p: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of tokens that the field labels as an entity and that no base span touches; neighbours of a kind are one."""
    taken = sorted((a, z) for _, a, z in base)
    out, k = [], 0
    best, sure = p.argmax(axis=1), p.max(axis=1)
    chained = {b: a for a, b, kind in graph.edges if kind == CHAIN}
    last = -1
    for i, (s, e) in enumerate(graph.spans):
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if best[i] == 0 or sure[i] < SURE or (k < len(taken) and taken[k][0] < e):
            continue
        m = _EDGE_OF_ENTITY.search(text, s, e)
        if m is None:
            continue
        kind = int(best[i]) - 1
        if out and last == chained.get(i, -2) and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], m.end())
        else:
            out.append((kind, *m.span()))
        last = i
    return out


def detect(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, base, added): arrays of (kind, start, end), by kind as listed and then start."""

    def run(batches):
        for b in batches:
            base = [base_spans(t) for t in b["text"]]
            graphs = [graph_of(t, x) for t, x in zip(b["text"], base)]
            added = [[] for _ in graphs]
            own = [i for i, g in enumerate(graphs) if g is not None and min(g.observed) < 0]  # else nothing is hidden
            if own:
                p, at = model.beliefs([graphs[i] for i in own]), 0
                for i in own:
                    n = len(graphs[i].spans)
                    added[i] = added_spans(b["text"][i], graphs[i], p[at : at + n], base[i])
                    at += n
            struct = lambda spans: [{"kind": KINDS[k], "start": a, "end": z} for k, a, z in sorted(spans)]
            yield {"doc_id": b["doc_id"], "base": [struct(x) for x in base], "added": [struct(x) for x in added]}

    span = "array<struct<kind:string,start:long,end:long>>"
    return arrow_map(texts(docs, id_col, text_col), run, f"doc_id long, base {span}, added {span}")


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")

    def digest(batches):
        written = lambda spans: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
        for b in batches:
            out = {"doc_id": b["doc_id"]}
            for k in KINDS:
                out[f"n_{k}"] = [sum(s["kind"] == k for s in spans) for spans in b["base"]]
            out["base_sha256"] = [sha256_hex(written(spans).encode()) for spans in b["base"]]
            both = [sorted([*x, *y], key=lambda s: (KINDS.index(s["kind"]), s["start"], s["end"])) for x, y in zip(b["base"], b["added"])]
            out["spans"] = [written(spans) for spans in both]
            out["n_added"] = [len(x) for x in b["added"]]
            yield out

    columns = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string, spans string, n_added long"])
    return arrow_map(detect(docs, train(docs)), digest, columns)
