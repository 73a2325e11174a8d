"""Secret scan by one combined automaton.

All rules are compiled into one minimal automaton (see automaton.py) that reads a text's
bytes once, from the end to the front; where it accepts for a rule, a match of that rule
starts.  From the leftmost such place on, the rule's own forward automaton finds the
longest match, and the search goes on behind it.  A rule's extra condition (a length that
counts only a part of the match) is checked then; a match that fails is dropped and not
tried again.

Defined results: null text counts as empty; a text without secrets gives zero counts, the
digest of the empty string and empty spans; repeated rows give a row each; an empty table
gives an empty result; only the id and the text are read.  Offsets count code points.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .automaton import compile_rules
from .base import arrow_map, read_table, sha256_hex, texts


def _either_case(word: str) -> str:
    return "".join(f"[{ch.upper()}{ch.lower()}]" if ch.isalpha() else ch for ch in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    check: str | None = None  # what a whole match must also match


_KEYWORD = "|".join(map(_either_case, ["password", "passwd", "secret", "token", "api_?key"]))
_ASSIGN = rf"({_KEYWORD})[\"']?\x20*[:=]\x20*[\"']?"

#: The contract's kinds. The least length of access and hex is part of the pattern: a run is taken whole or not at all.
BASE = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]+", _ASSIGN + r"[A-Za-z0-9+/_.=-]{6,}"),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds that the same pass finds.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]+", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = BASE + MORE):
        self.rules = rules
        everything = compile_rules([r.pattern for r in rules], backwards=True, anywhere=True)
        self.classes, self.first, self.n_states = everything.classes, everything.linked(), len(everything.rows)
        self.forward = []
        for r in rules:
            own = compile_rules([r.pattern])
            self.forward.append((own.classes, own.linked()))
        self.checks = [re.compile(r.check.encode()) if r.check else None for r in rules]

    def byte_spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, by start and then rule."""
        row, at, starts, bits, end = self.first, len(data), [], 0, 0
        for b in data[::-1].translate(self.classes):
            row = row[b]
            if row[-1] != bits:
                if bits:
                    starts.append((at, end, bits))
                bits, end = row[-1], at
            at -= 1
        if bits:
            starts.append((0, end, bits))
        out = []
        for k in range(len(self.rules)) if starts else ():
            free, check = 0, self.checks[k]
            for first, end, bits in reversed(starts):  # at each place from first to end matches of these rules start
                at = max(first, free)
                while bits >> k & 1 and at < end:
                    free = self._longest(data, at, k)
                    if check is None or check.fullmatch(data, at, free):
                        out.append((at, free, k))
                    at = free
        return sorted(out)

    def _longest(self, data: bytes, at: int, k: int) -> int:
        classes, row = self.forward[k]
        end = at
        while at < len(data):
            row = row[classes[data[at]]]
            if not row:
                break
            at += 1
            if row[-1]:
                end = at
        return end

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, rule) in code points."""
        data = text.encode("utf-8", "surrogatepass")
        found = self.byte_spans(data)
        if not found or len(data) == len(text):
            return found
        place, chars, before = {}, 0, 0
        for p in sorted({x for s, e, _ in found for x in (s, e)}):
            chars += len(data[before:p].decode("utf-8", "surrogatepass"))
            place[p], before = chars, p
        return [(place[s], place[e], k) for s, e, k in found]


_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, spans): spans is an array of (kind, start, end), by start and then by the rules' order."""
    kinds = [r.kind for r in rules]

    def run(batches):
        s = scanner(rules)
        for b in batches:
            yield {"doc_id": b["doc_id"], "spans": [[{"kind": kinds[k], "start": a, "end": z} for a, z, k in s.spans(t)] for t in b["text"]]}

    return arrow_map(texts(docs, id_col, text_col), run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.kind for r in BASE]

    def digest(batches):
        for b in batches:
            out = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for doc_id, spans in zip(b["doc_id"], b["spans"]):
                written = [(s["kind"], f"{s['kind']}:{s['start']}:{s['end']}") for s in spans]
                own = [k for k, _ in written]
                out["doc_id"].append(doc_id)
                for k in base:
                    out[f"n_{k}"].append(own.count(k))
                out["base_sha256"].append(sha256_hex(",".join(w for k, w in written if k in base).encode()))
                out["spans"].append(",".join(w for _, w in written))
            yield out

    found = scan(read_table(spark, sf_dir, "documents"))
    return arrow_map(found, digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
