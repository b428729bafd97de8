"""Conversations brought into order: an optional system row, then user and assistant in turn.

Rows are kept (K), given another role (R, cost 2), deleted (D, 3) or preceded by an inserted
empty row (I, 2), so that the initials of the roles read ``(s?(ua)+)?``; blank rows and repeats of an earlier row
must go, and a truncated row that stays costs 1 more. Of the cheapest edits those with the least audit (the letters in
order) are taken.

What a row can do to the four states of that pattern is a 4 by 4 min-plus matrix whose
entries hold a cost and the least audit of that cost. It depends on the row's role initial and fault
only, so a conversation is a word over nine symbols. The words of a batch of conversations are compressed together by
Re-Pair: the pair of symbols that stands most often becomes a rule, until no pair stands
``least_uses`` times. A rule's matrix is the product of its two, made once, bottom-up, and
shared by all conversations; audits are ropes, joined without copying and read only to
settle ties. Audits of equal cost over the same rows are never one the beginning of the other, so the least of joined
parts is the join of the least parts, and the product is exact.

Rows are dealt by conversation and sorted in Spark, and streamed: one that is longer than a batch is carried
from batch to batch as at most four states (cost, audit, hash so far), so memory doesn't grow with its
texts. Its rows pass through one task, since a hash of the whole is asked for.

Defined results for unusual rows: a null role or text is one space, so such a text is blank; a null
conv_id is a conversation of its own; null turns come first; rows of one turn are taken by role and then
text; a role that starts otherwise than s, u and a fits nowhere and must be given another or go; a
conversation without rows has zeros, an empty audit and the hash of an empty string; gaps beyond
a long are its greatest; an empty table gives no rows; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what the last role was; the first and the last may end
_NEXT_ROLE = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
_KEEPS = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_LEGAL = {"su", "ua", "au"}
GONE, TRUNCATED = 0, 4  # symbols: 0 must go; 1 to 4 are s, u, a and other; 4 more if truncated
_INITIALS = "sua"
_LONG = (1 << 63) - 1


class Rope:
    """A text as the join of two, put together when it is read."""

    __slots__ = ("left", "right", "whole")

    def __init__(self, left, right):
        self.left, self.right, self.whole = left, right, None

    def text(self) -> str:
        if self.whole is None:
            out, todo = [], [self]
            while todo:
                r = todo.pop()
                if isinstance(r, str):
                    out.append(r)
                elif r.whole is not None:
                    out.append(r.whole)
                else:
                    todo += [r.right, r.left]
            self.whole = "".join(out)
            self.left = self.right = ""
        return self.whole


def read(audit) -> str:
    return audit if isinstance(audit, str) else audit.text()


def join(a, b):
    return b if a == "" else a if b == "" else Rope(a, b)


def better(new, old) -> bool:
    """Entries start with cost and audit; None is no way at all."""
    return old is None or new[0] < old[0] or (new[0] == old[0] and read(new[1]) < read(old[1]))


def product(a, b):
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for k in range(4):
            if a[i][k] is not None:
                for j in range(4):
                    if b[k][j] is not None:
                        new = (a[i][k][0] + b[k][j][0], join(a[i][k][1], b[k][j][1]))
                        if better(new, out[i][j]):
                            out[i][j] = new
    return out


def _inserts():
    """Any number of inserted rows."""
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        out[i][i] = (0, "")
        j, audit = i, ""
        for _ in range(2):
            j, audit = _NEXT_ROLE[j][1], audit + "I"
            if out[i][j] is None:
                out[i][j] = (2 * len(audit), audit)
    return out


INSERTS = _inserts()


def _row(symbol: int):
    """What a row can do, after any inserted rows."""
    own = [[None] * 4 for _ in range(4)]
    for i in range(4):
        own[i][i] = (3, "D")
        if symbol != GONE:
            more = int(symbol > TRUNCATED)
            new = (2 + more, "R")
            j = _NEXT_ROLE[i][1]
            if better(new, own[i][j]):
                own[i][j] = new
            kept = _KEEPS.get(("sua-"[(symbol - 1) % TRUNCATED], i))
            if kept is not None and better((more, "K"), own[i][kept]):
                own[i][kept] = (more, "K")
    return product(INSERTS, own)


TERMINALS = [_row(k) for k in range(9)]


def re_pair(words: np.ndarray, least_uses: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Symbols with -1 between words, compressed, and the rules: rule k makes symbol 9 + k."""
    rules: list[tuple[int, int]] = []
    while len(words) > 1:
        inside = (words[:-1] >= 0) & (words[1:] >= 0)
        pairs = np.where(inside, words[:-1] << 32 | words[1:], -1)
        codes, uses = np.unique(pairs[inside], return_counts=True)
        if not len(codes) or uses.max() < least_uses:
            break
        best = codes[np.argmax(uses)]
        at = np.flatnonzero(pairs == best)
        if best >> 32 == best & 0xFFFFFFFF:  # in a run of one symbol every other pair
            first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            at = at[(np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))) % 2 == 0]
        words = words.copy()
        words[at] = len(TERMINALS) + len(rules)
        words = np.delete(words, at + 1)
        rules.append((int(best >> 32), int(best & 0xFFFFFFFF)))
    return words, rules


class Grammar:
    """Matrices of symbols; a rule is known by what it stands for, so a later batch uses it again."""

    def __init__(self, least_uses: int, most: int = 4096):
        self.least_uses, self.most = least_uses, most
        self.known: dict[bytes, list] = {}

    def compress(self, words: np.ndarray) -> tuple[np.ndarray, list]:
        words, rules = re_pair(words, self.least_uses)
        if len(self.known) > self.most:
            self.known.clear()
        spelled, matrices = [bytes([k]) for k in range(len(TERMINALS))], list(TERMINALS)
        for a, b in rules:
            name = spelled[a] + spelled[b]
            if name not in self.known:
                self.known[name] = product(matrices[a], matrices[b])
            spelled.append(name)
            matrices.append(self.known[name])
        return words, matrices


def advance(states, symbols, matrices):
    """Entries (cost, audit, first state) of the ways from ``states`` through the symbols."""
    for s in symbols:
        m, out = matrices[s], [None] * 4
        for i, e in enumerate(states):
            if e is not None:
                for j, x in enumerate(m[i]):
                    if x is not None:
                        new = (e[0] + x[0], join(e[1], x[1]), e[2])
                        if better(new, out[j]):
                            out[j] = new
        states = out
    return states


def edited(audit: str, state: int, roles: list[str], texts: list[str]):
    """The rows (role, text) that an audit makes of rows, from a state."""
    at = 0
    for letter in audit:
        if letter == "I":
            role, state = _NEXT_ROLE[state]
            yield role, ""
            continue
        if letter == "K":
            state = _KEEPS[roles[at][:1], state]
            yield roles[at], texts[at]
        elif letter == "R":
            role, state = _NEXT_ROLE[state]
            yield role, texts[at]
        at += 1


class Digest:
    """Hash of repaired rows, joined by line ends."""

    def __init__(self):
        self.hash, self.empty = hashlib.sha256(), True

    def copy(self) -> Digest:
        out = Digest()
        out.hash, out.empty = self.hash.copy(), self.empty
        return out

    def add(self, rows) -> Digest:
        for role, text in rows:
            self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
            self.empty = False
        return self


class Conversation:
    """A conversation as far as it has been read."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.least = self.last = self.initial = None
        self.turns = 0
        self.done = []  # letters that all ways share
        self.ways = [(0, "", Digest()), None, None, None]  # cost, letters after the shared ones, hash

    def note(self, turn, role: str, fault: str) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last
            self.last = turn
        if fault:
            self.n[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.n["illegal"] += 1
        self.initial = role[:1]

    def read(self, symbols, matrices, roles: list[str], texts: list[str]) -> None:
        """Takes a stretch of rows."""
        start = [None if w is None else (w[0], w[1], i) for i, w in enumerate(self.ways)]
        self._move(advance(start, symbols, matrices), roles, texts)

    def _move(self, found, roles, texts) -> None:
        new = []
        for e in found:
            if e is None:
                new.append(None)
                continue
            _, before, digest = self.ways[e[2]]
            letters = read(e[1])
            new.append((e[0], letters, digest.copy().add(edited(letters[len(before) :], e[2], roles, texts))))
        shared = commonprefix([w[1] for w in new if w is not None])
        self.done.append(shared)
        self.ways = [None if w is None else (w[0], w[1][len(shared) :], w[2]) for w in new]

    def finish(self, symbols=(), matrices=(), roles=(), texts=()) -> tuple:
        """Takes the last rows: cost, audit and hash of the cheapest way that may end."""
        start = [None if w is None else (w[0], w[1], i) for i, w in enumerate(self.ways)]
        found = advance(advance(start, symbols, matrices), (0,), [INSERTS])
        best = None
        for state in (NOTHING, ASSISTANT):
            if found[state] is not None and better(found[state], best):
                best = found[state]
        _, before, digest = self.ways[best[2]]
        letters = read(best[1])
        digest.add(edited(letters[len(before) :], best[2], roles, texts))
        gaps = 0 if self.least is None else min(self.last - self.least + 1 - self.turns, _LONG)
        return (self.conv_id, gaps, *(self.n[k] for k in ("blank", "duplicate", "truncated", "illegal")), best[0], "".join(self.done) + letters, digest.hash.hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FAULTS = ("", "blank", "duplicate", "truncated")


def with_faults(rows: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, present, fault (place in _FAULTS) and symbol of each row,
    dealt by conversation and sorted within. ``present`` names a column that is false in rows
    that only keep their conversation; without it all rows count."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    there = F.col(present) if present else F.lit(True)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), there.alias("present"))
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    solid = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(solid == "", 1).when(F.col("nth") > 1, 2).when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    initial = F.when(F.col("role") == "", 0).otherwise(F.instr(F.lit(_INITIALS), F.substring("role", 1, 1)))
    kind = F.when(initial == 0, 4).otherwise(initial)
    rows = rows.withColumn("fault", fault)
    symbol = F.when(F.col("fault").isin(1, 2), GONE).when(F.col("fault") == 3, kind + TRUNCATED).otherwise(kind)
    rows = rows.withColumn("symbol", symbol)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("nth")]
    return rows.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "present", F.col("fault").cast("int").alias("fault"), F.col("symbol").cast("int").alias("symbol"))


def _stretches(batch) -> list[tuple[int, int]]:
    """Starts and ends of the conversations of a batch."""
    ids = batch.column(0).to_pylist()
    cuts = [0, *(k for k in range(1, len(ids)) if ids[k] != ids[k - 1]), len(ids)]
    return list(zip(cuts[:-1], cuts[1:], strict=True)) if ids else []


def _repaired(batches, least_uses: int):
    """The results of a task's conversations, for each batch."""
    grammar, held = Grammar(least_uses), None
    for b in batches:
        ids, turns, roles, texts, present, faults, symbols = (c.to_pylist() for c in b.columns)
        spans, words, out = _stretches(b), [], []
        for s, e in spans:
            words += [symbols[k] for k in range(s, e) if present[k]]
            words.append(-1)
        packed, matrices = grammar.compress(np.array(words, dtype=np.int64))
        ends = np.flatnonzero(packed == -1)
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else []
        for number, (s, e) in enumerate(spans):
            if held is not None and (number or held.conv_id != ids[s]):
                out.append(held.finish())
                held = None
            held = held or Conversation(ids[s])
            rows = [k for k in range(s, e) if present[k]]
            for k in rows:
                held.note(turns[k], roles[k], _FAULTS[faults[k]])
            stretch = (packed[starts[number] : ends[number]].tolist(), matrices, [roles[k] for k in rows], [texts[k] for k in rows])
            if number + 1 < len(spans):
                out.append(held.finish(*stretch))
                held = None
            else:
                held.read(*stretch)
        yield out
    if held is not None:
        yield [held.finish()]


def repair_audits(rows: DataFrame, least_uses: int = 8, present: str | None = None) -> DataFrame:
    """conv_id, gaps, the rows of each first fault, illegal neighbours, and the cost, audit
    and hash of the cheapest repair of each conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        types = None

        def watched():
            nonlocal types
            for b in batches:
                types = [b.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
                yield b

        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        for out in _repaired(watched(), least_uses):
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return with_faults(rows, present).mapInArrow(run, f"conv_id {kind}, {RESULT}")


def repaired_rows(rows: DataFrame, least_uses: int = 8, present: str | None = None) -> DataFrame:
    """conv_id, place, role and text of the repaired conversations. Each row meets its
    letters of the audit by its place among the rows of its conversation."""
    audits = repair_audits(rows, least_uses, present).select("conv_id", "audit")
    # A row's letters are the inserts before it and its own; those after the last are a row's without text.
    letters = F.regexp_extract_all(F.col("audit"), F.lit("(I*[DKR]|I+$)"), F.lit(1))
    steps = audits.select("conv_id", F.posexplode(letters).alias("nth", "letters"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text", F.desc("symbol"))
    own = with_faults(rows, present).filter("present").withColumn("nth", F.row_number().over(order) - 1)
    both = steps.withColumnRenamed("conv_id", "c").withColumnRenamed("nth", "n").join(own, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("n") == F.col("nth")), "left")
    last = F.right("letters", F.lit(1))
    made = F.transform(F.sequence(F.lit(1), F.length("letters") - F.when(last == "D", 1).otherwise(0)), lambda k: F.struct(
        F.when((k == F.length("letters")) & (last != "I"), F.when(last == "K", F.col("role"))).alias("role"),
        F.when((k == F.length("letters")) & (last != "I"), F.col("text")).otherwise(F.lit("")).alias("text")))
    made = F.when((F.length("letters") > 1) | (last != "D"), made)
    flat = both.select(F.col("c").alias("conv_id"), F.col("n").alias("nth"), F.posexplode(made).alias("k", "x")).select("conv_id", "nth", "k", "x.*")
    flat = flat.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("nth", "k")))
    # What follows an optional system row is user and assistant in turn.
    first = F.first(F.coalesce(F.startswith("role", F.lit("s")), F.lit(False))).over(Window.partitionBy("conv_id").orderBy("place"))
    parity = (F.col("place") - F.when(first, 1).otherwise(0)) % 2
    return flat.select("conv_id", "place", F.coalesce("role", F.when(parity == 1, "user").otherwise("assistant")).alias("role"), "text")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults sown by a checksum of conversation and turn: of 20, one is dropped, emptied, loses its
    sentence ends, is repeated or becomes the user's. Dropped rows stay, not ``present``."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fate.alias("fate"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fate") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
