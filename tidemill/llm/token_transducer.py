"""Token counts by a tokenizer that is compiled to deterministic transducers.

Two machines in a row read the text once.

The first (``Counter.feed``) cuts text into pieces.  It has 12 states and reads a character's
class; the classes are asked from the library itself, once for each distinct character.
What a character decides may be the end of a piece that began before it, so a state holds
at most two pending characters.

``CountTransducer`` reads the bytes of a piece.  Every transition carries the change of the
number of tokens of what has been read: the sum along a path is the count.  The encoding of
a prefix by byte-pair merges is fixed by its last token and the encoding of the rest, and a
token may follow another iff no merge joins them while both ends of the border are alive.
So a state needs, for each vocabulary entry that might still end here (a node of the
vocabulary's trie), the token before it and the count up to there.  States and transitions
are compiled when they are first met; the tables are dropped when they reach
``MOST_STATES`` and grow again, which changes no count.  Counts of short pieces, and of what
lies between two spaces, are remembered as one transition from the start state.

A long text is cut into chunks, with no regard to pieces.  A chunk's *state map* says, for
every state of the first machine at its left border, how many characters depend on what
came before (``head``), and then the count and the state at its right border.  Such maps
compose, associatively: a head is read by the machines from the state that the map before
ends in; where a whole chunk depends on what came before, heads are laid together.  A scan
of radix ``RADIX`` composes the maps of all prefixes of a text in
``log(chunks) / log(RADIX)`` rounds; the prefix up to a chunk gives the state and the
tokens before its end, and the last one, closed, the text's count.

Special tokens in a text count as one each, as the library treats them by default, and end
the text around them; that is why a text is first split at them.

Defined results: null text counts as empty and has 0 tokens; repeated rows and rows with a
null id give a row each; an empty table gives an empty result; only the id and the text
are read.
"""

from __future__ import annotations

import json
import pickle
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import arrow_map, materialize, read_table, texts

CHUNK_CHARS = 32768
RADIX = 16
MOST_STATES = 250_000
MOST_PIECES = 200_000
MOST_UNITS = 600_000

LETTER, DIGIT, OTHER, BLANK, SPACE, QUOTE = range(6)
START, IN_LETTERS, IN_DIGITS, IN_OTHERS, ONE_SPACE, ONE_BLANK, END_SPACE, END_BLANK, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(12)
RUN_OF = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS}
SUFFIX_OF = {QUOTED_R: "e", QUOTED_V: "e", QUOTED_L: "l"}
#: A non-blank before a blank: whatever was pending, a piece ends there.
SURE = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \t\n\r])")

_COUNTERS: dict[str, Counter] = {}


class CountTransducer:
    """Bytes of a piece -> number of tokens, by transitions that carry the change of the count."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int | None] = [None]
        for token, number in tokens.items():
            node = 0
            for b in token:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token_at.append(None)
                node = self.trie[node][b]
            self.token_at[node] = number
        self.rank = {(tokens[a], tokens[b]): r for r, (a, b) in enumerate(merges)}
        halves = {tokens[a + b]: (tokens[a], tokens[b]) for a, b in merges}
        made = {tokens[a + b]: r for r, (a, b) in enumerate(merges)}
        # tokens that lie at a token's right (left) end while it is merged, each with the rank at which it goes into the next
        self.right_ends = {t: self._ends(t, halves, made, 1) for t in tokens.values()}
        self.left_ends = {t: self._ends(t, halves, made, 0) for t in tokens.values()}
        self.reset()

    @staticmethod
    def _ends(token: int, halves: dict, made: dict, side: int) -> list[tuple[int, float]]:
        out, gone = [], float("inf")
        while True:
            out.append((token, gone))
            if token not in halves:
                return out
            gone, token = made[token], halves[token][side]

    def reset(self) -> None:
        self.states: list[tuple] = [((0, None, 0),)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.next: list[dict[int, tuple[int, int]]] = [{}]
        self.follows: dict[tuple[int, int], bool] = {}

    def may_follow(self, a: int | None, b: int) -> bool:
        """Whether a, b is the encoding of their bytes: no pair across the border merges while both are there."""
        if a is None:
            return True
        known = self.follows.get((a, b))
        if known is None:
            known = True
            for x, x_gone in self.right_ends[a]:
                for y, y_gone in self.left_ends[b]:
                    r = self.rank.get((x, y))
                    # of equal pairs the leftmost merges first
                    if r is not None and r < x_gone and r <= y_gone:
                        known = False
            self.follows[a, b] = known
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        reached = [(self.trie[node].get(byte), before, count) for node, before, count in self.states[state]]
        reached = [x for x in reached if x[0] is not None]
        for node, before, count in reached:
            token = self.token_at[node]
            if token is not None and self.may_follow(before, token):
                break
        else:
            raise ValueError(f"no token ends at byte {byte}")
        change = count + 1
        key = (*((n, t, c - change) for n, t, c in reached if self.trie[n]), (0, token, 0))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        self.next[state][byte] = (to, change)
        return to, change

    def run(self, state: tuple, data: bytes) -> tuple[tuple, int]:
        """From one state (a key, good on any worker) over bytes: the state reached and the change of the count."""
        if len(self.states) > MOST_STATES:
            self.reset()
        at = self.number.get(state)
        if at is None:
            at = self.number[state] = len(self.states)
            self.states.append(state)
            self.next.append({})
        total = 0
        for b in data:
            step = self.next[at].get(b) or self.compile(at, b)
            at = step[0]
            total += step[1]
        return self.states[at], total

    def count(self, data: bytes) -> int:
        if len(self.states) > MOST_STATES:
            self.reset()
        at, total, following = 0, 0, self.next
        for b in data:
            step = following[at].get(b) or self.compile(at, b)
            at = step[0]
            total += step[1]
        return total


#: State of the count transducer before a piece's first byte.
FRESH = ((0, None, 0),)
#: A configuration of each state.  Those of DEPENDENT have others too, as a piece that began before them goes on.
ENTRIES = {
    START: (START, FRESH, ""),
    IN_LETTERS: (IN_LETTERS, FRESH, ""),
    IN_DIGITS: (IN_DIGITS, FRESH, ""),
    IN_OTHERS: (IN_OTHERS, FRESH, ""),
    ONE_SPACE: (ONE_SPACE, FRESH, " "),
    ONE_BLANK: (ONE_BLANK, FRESH, "\n"),
    END_SPACE: (END_SPACE, FRESH, " "),
    END_BLANK: (END_BLANK, FRESH, "\n"),
    QUOTED: (QUOTED, FRESH, "'"),
    QUOTED_R: (QUOTED_R, FRESH, "'r"),
    QUOTED_V: (QUOTED_V, FRESH, "'v"),
    QUOTED_L: (QUOTED_L, FRESH, "'l"),
}
DEPENDENT = {IN_LETTERS, IN_DIGITS, IN_OTHERS, ONE_BLANK, END_SPACE, END_BLANK}


class Counter(dict):
    """Both machines for one vocabulary.  As a dict: piece -> its tokens, filled on demand."""

    def __init__(self, path: str):
        super().__init__()
        import regex
        from tokenizers import Tokenizer

        with open(path) as f:
            stored = json.load(f)
        split = stored["pre_tokenizer"]
        if stored["model"]["type"] != "BPE" or stored["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("only byte-level BPE without normalizer and prefix space is compiled")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        byte_of = self._alphabet()
        raw = lambda s: bytes(byte_of[c] for c in s)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in stored["model"]["merges"]]
        specials = {t["content"] for t in stored["added_tokens"]}
        tokens = {raw(t): i for t, i in stored["model"]["vocab"].items() if t not in specials}
        self.transducer = CountTransducer(tokens, [(raw(a), raw(b)) for a, b in pairs])
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) or "(?!)")
        self.units: dict[str, int] = {}
        self.unsure = regex.compile(r"[\s\x1c-\x1f] ").search
        self.classes: dict[str, int] = {" ": SPACE, "'": QUOTE}
        self.amended: dict[str, int] = {}  # characters whose class here is not that of the regex module's Unicode version
        self._make_pattern()

    @staticmethod
    def _alphabet() -> dict[str, int]:
        """Printable characters that stand for bytes in a byte-level vocabulary."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def _make_pattern(self) -> None:
        import regex

        def chars(name: str, k: int) -> str:
            of = "".join(regex.escape(c) for c in sorted(self.amended))
            own = "".join(regex.escape(c) for c, x in sorted(self.amended.items()) if x == k)
            plain = f"[{name}--[{of}]]" if of else name
            return f"[{plain}||[{own}]]" if own else f"[{plain}]"

        letter, digit, blank = chars(r"\p{L}", LETTER), chars(r"\p{N}", DIGIT), chars(r"\s", BLANK)
        other = f"(?:(?!{letter}|{digit}|{blank}).)"
        other = other if self.amended else r"[^\s\p{L}\p{N}]"
        self.pattern = regex.compile(rf"(?V1)(?s)'(?:[stmd]|re|ve|ll)| ?{letter}+| ?{digit}+| ?{other}+|{blank}+(?!(?!{blank}).)|{blank}+")

    def __missing__(self, piece: str) -> int:
        n = self.transducer.count(piece.encode("utf-8"))
        if len(piece) <= 32:
            if len(self) >= MOST_PIECES:
                self.clear()
            self[piece] = n
        return n

    def class_of(self, char: str) -> int:
        """Asked from the library: a character has the class of what it stays in one piece with."""
        found = self.classes.get(char)
        if found is None:
            whole = lambda s: len(self.splitter.pre_tokenize_str(s)) == 1
            found = LETTER if whole("a" + char) else DIGIT if whole("1" + char) else OTHER if whole("!" + char) else BLANK
            self.classes[char] = found
            if found != self._own_class(char):
                self.amended[char] = found
                self.pattern = None
        return found

    @staticmethod
    def _own_class(char: str) -> int:
        import regex

        return LETTER if regex.match(r"\p{L}", char) else DIGIT if regex.match(r"\p{N}", char) else BLANK if regex.match(r"\s", char) else OTHER

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self._count, parts))
        return self._count(text)

    def _count(self, text: str) -> int:
        """A piece starts at every space that follows a non-blank; so texts with no other spaces are counted by what
        lies between spaces, and that is remembered, too."""
        if not text.isascii():
            for c in set(text).difference(self.classes):
                self.class_of(c)
        if self.pattern is None:
            self._make_pattern()
        if self.unsure(text):
            return sum(map(self.__getitem__, self.pattern.findall(text)))
        first, *rest = text.split(" ")
        units = self.units
        if len(units) >= MOST_UNITS:
            units.clear()
        for u in set(rest).difference(units):
            units[u] = sum(map(self.__getitem__, self.pattern.findall(" " + u)))
        return sum(map(self.__getitem__, self.pattern.findall(first))) + sum(map(units.__getitem__, rest))

    # -- one character at a time, from any state; a configuration is (state, count state, pending characters)

    def feed(self, config: tuple, text: str) -> tuple[tuple, int]:
        """The configuration after text, and the tokens that became certain (all but those of pending characters)."""
        state, at, pending = config
        total = 0
        for c in text:
            k = self.class_of(c)
            ends = self.ends_before(state, k)
            if ends:
                total += self.close((state, at, pending), k)
                # the last space of a run belongs to what follows
                state, at, pending = (ONE_SPACE, FRESH, " ") if ends == 2 else (START, FRESH, "")
            state, at, pending, n = self.step(state, at, pending, c, k)
            total += n
        return (state, at, pending), total

    @staticmethod
    def ends_before(state: int, k: int) -> int:
        """1: what was read is done before a character of class k; 2: but for a pending space; 0: it goes on or is undecided."""
        if state in (IN_LETTERS, IN_DIGITS, IN_OTHERS):
            return int(RUN_OF.get(k) != state)
        if state == ONE_BLANK or state == END_BLANK:
            return int(k not in (BLANK, SPACE))
        if state == END_SPACE:
            return 0 if k in (BLANK, SPACE) else 2
        return 0

    def close(self, config: tuple, k: int | None = None) -> int:
        """Tokens still owed when a piece ends before a character of class k, or the text ends (None)."""
        state, at, pending = config
        if not pending or state == END_SPACE and k is not None:
            return 0
        if state in (QUOTED_R, QUOTED_V, QUOTED_L) or state == END_BLANK and k is not None:
            # the mark is a piece and so is the letter; the last blank of a run before something else is one, too
            return sum(self[p] for p in pending)
        return self.transducer.run(at, pending.encode("utf-8"))[1]

    def step(self, state: int, at: tuple, pending: str, c: str, k: int) -> tuple:
        run = self.transducer.run
        if state in (QUOTED, QUOTED_R, QUOTED_V, QUOTED_L):
            if state == QUOTED and c in "stmd" or SUFFIX_OF.get(state) == c:
                return START, FRESH, "", self[pending + c]
            if state == QUOTED and c in "rvl":
                return {"r": QUOTED_R, "v": QUOTED_V, "l": QUOTED_L}[c], FRESH, pending + c, 0
            # no contraction after all: the mark begins a run of others, the letter behind it one of letters
            at, one = run(FRESH, b"'")
            config, n = self.feed((IN_OTHERS, at, ""), pending[1:] + c)
            return *config, n + one
        if state == START:
            if k == QUOTE:
                return QUOTED, FRESH, c, 0
            if k in (SPACE, BLANK):
                return (ONE_SPACE if k == SPACE else ONE_BLANK), FRESH, c, 0
            at, n = run(FRESH, c.encode("utf-8"))
            return RUN_OF[k], at, "", n
        if state in (ONE_SPACE, ONE_BLANK, END_SPACE, END_BLANK):
            at, n = run(at, pending.encode("utf-8"))
            if k in (SPACE, BLANK):
                return (END_SPACE if k == SPACE else END_BLANK), at, c, n
            at, m = run(at, c.encode("utf-8"))  # one space, joined to what follows
            return RUN_OF[k], at, "", n + m
        at, n = run(at, c.encode("utf-8"))
        return state, at, "", n

    # -- state maps of chunks

    def state_map(self, chunk: str) -> dict[int, tuple]:
        """Entry state -> (head, then).  Past its head a chunk owes nothing to what came before; then is the
        configuration at its end and the tokens behind the head, or None if all of the chunk is head.

        From a sure border on all entries agree, and what lies between sure borders is counted by pieces.
        """
        tails: dict[int, tuple] = {}
        out = {}
        for entry, config in ENTRIES.items():
            size = 0
            if entry in DEPENDENT:
                size = next((i + 1 for i, c in enumerate(chunk) if self._piece_starts(entry, c)), 0)
                if not size:
                    out[entry] = (chunk, None)
                    continue
            config, _ = self.feed(config, chunk[:size])
            sure = SURE.search(chunk, size)
            if sure is None:
                out[entry] = (chunk[:size], self.feed(config, chunk[size:]))
                continue
            cut = sure.start()
            if cut not in tails:
                tails[cut] = self._from_start(chunk[cut:])
            config, n = self.feed(config, chunk[size:cut])
            end, more = tails[cut]
            out[entry] = (chunk[:size], (end, n + self.close(config, BLANK) + more))
        return out

    def _piece_starts(self, entry: int, char: str) -> bool:
        k = self.class_of(char)
        if entry in (IN_LETTERS, IN_DIGITS, IN_OTHERS):
            return RUN_OF.get(k) != entry
        return k not in (BLANK, SPACE)

    def _from_start(self, text: str) -> tuple[tuple, int]:
        """Configuration and tokens of a text that begins at a sure border."""
        cut = 0
        for sure in SURE.finditer(text, max(0, len(text) - 512)):
            cut = sure.start()
        config, n = self.feed(ENTRIES[START], text[cut:])
        return config, n + self._count(text[:cut])

    def apply(self, known: tuple, later: dict[int, tuple]) -> tuple:
        """A configuration and the tokens before it, carried through a map."""
        config, n = known
        head, then = later[config[0]]
        end, more = self.feed(config, head)
        return (end, n + more) if then is None else (then[0], n + more + then[1])

    def compose(self, a: dict[int, tuple], b: dict[int, tuple]) -> dict[int, tuple]:
        """The map of a's text followed by b's."""
        out = {}
        for entry, (head, then) in a.items():
            if then is not None:
                out[entry] = (head, self.apply(then, b))
            else:
                more, then = b[self.feed(ENTRIES[entry], head)[0][0]]
                out[entry] = (head + more, then)
        return out

    def total(self, prefix: dict[int, tuple]) -> int:
        """Tokens of the text that a map stands for."""
        config, n = self.apply((ENTRIES[START], 0), prefix)
        return n + self.close(config)


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, limit: int = 1024, vocabulary: str | None = None, chunk_chars: int = CHUNK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each input row."""
    vocabulary = vocabulary or default_vocabulary()
    rows = texts(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))

    def whole(batches):
        c = counter(vocabulary)
        for b in batches:
            yield {"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": list(map(c.count, b["text"]))}

    kind = "doc_id long, n_bytes long, n_tokens long"
    short = arrow_map(rows.filter(F.length("text") <= chunk_chars), whole, kind)
    long = rows.filter(F.length("text") > chunk_chars).withColumn("uid", F.monotonically_increasing_id())
    ends = _prefixes(long, vocabulary, chunk_chars).filter("last").groupBy("uid", "doc_id", "n_bytes").agg(F.sum("n_tokens").cast("long").alias("n_tokens"))
    counts = short.unionByName(ends.drop("uid"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def _prefixes(rows: DataFrame, vocabulary: str, chunk_chars: int) -> DataFrame:
    """Rows (uid, doc_id, n_bytes, part, no, last, n_tokens): tokens of the text up to a chunk's end within a part
    (what lies between special tokens), closed there; a special token counts at the end of the part before it."""

    def split(batches):
        c = counter(vocabulary)
        for b in batches:
            for uid, doc_id, n_bytes, text in zip(b["uid"], b["doc_id"], b["n_bytes"], b["text"]):
                parts = c.special.split(text)
                for p, part in enumerate(parts):
                    for no, at in enumerate(range(0, max(1, len(part)), chunk_chars)):
                        last = at + chunk_chars >= len(part)
                        extra = int(last and p + 1 < len(parts))
                        yield {"uid": [uid], "doc_id": [doc_id], "n_bytes": [n_bytes], "part": [p], "no": [no], "last": [last], "extra": [extra], "text": [part[at : at + chunk_chars]]}

    def maps(batches):
        c = counter(vocabulary)
        for b in batches:
            yield {k: b[k] for k in keys} | {"map": [pickle.dumps(c.state_map(t)) for t in b["text"]]}

    def compose(batches):
        c = counter(vocabulary)
        for b in batches:
            out = []
            for window in b["window"]:
                first, *rest = (pickle.loads(x["map"]) for x in window)
                for x in rest:
                    first = c.compose(first, x)
                out.append(pickle.dumps(first))
            yield {k: b[k] for k in keys} | {"map": out}

    def close(batches):
        c = counter(vocabulary)
        for b in batches:
            yield {k: b[k] for k in keys[:-1]} | {"n_tokens": [c.total(pickle.loads(m)) + x for m, x in zip(b["map"], b["extra"])]}

    keys = ["uid", "doc_id", "n_bytes", "part", "no", "last", "extra"]
    fields = "uid long, doc_id long, n_bytes long, part int, no int, last boolean"
    chunks = arrow_map(rows, split, f"{fields}, extra int, text string")
    scanned = materialize(arrow_map(chunks.repartition("uid", "part", "no"), maps, f"{fields}, extra int, map binary"), "maps", keep=True)
    most = scanned.agg(F.max("no")).first()[0] or 0
    stride = 1
    while stride <= most:
        lane = Window.partitionBy("uid", "part", F.col("no") % stride).orderBy("no").rowsBetween(1 - RADIX, 0)
        windows = scanned.withColumn("window", F.sort_array(F.collect_list(F.struct("no", "map")).over(lane)))
        scanned = arrow_map(windows.select(*keys, "window"), compose, f"{fields}, extra int, map binary")
        stride *= RADIX
    return arrow_map(scanned, close, f"{fields}, n_tokens long")


def op12_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))
