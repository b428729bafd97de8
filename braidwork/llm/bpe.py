"""BPE encoding and decoding by a depth-first walk over the trie of distinct words.

The words of a batch are put in a trie and visited depth first (their sorted order is
that walk; the states of the current path are a stack). A node's state is the last token
of the encoding of its prefix: the one vocabulary token that ends there and whose left
neighbour, the state of the node where it starts, would not merge across the boundary.
A prefix that many words share is therefore encoded once. A word's tokens are read back
from the states of its path.

Whether two neighbouring tokens stay apart is decided by replaying, in rank order, the
merges that made the end of the left and the start of the right one.

Words are split and lower-cased by the character classes of the library that defines the
encoding: the driver reads them off the library once and sends them with the job, so that
results don't depend on the Unicode version of any worker's Python.

Long texts are read in pieces that end at a space, so memory is bounded by the piece and
by ``cache_words``, the words whose encodings are kept between pieces.

Defined results for unusual rows: null or blank text has no tokens (the hashes are those
of the empty string); a null doc_id passes through; repeated rows give one row each; of
merges with one rank the leftmost comes first, so there are no ties; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "</w>"
SHORT = "'(?:s|t|re|ve|m|ll|d)"


@lru_cache
def character_tables() -> tuple[str, str, str, dict[str, str]]:
    """Letters, numbers and white space as the insides of character classes, and the
    lower-case form of each character that has one, as the tokenizers library sees them.

    Read are all code points of the planes that hold letters, numbers or spaces.
    """
    from tokenizers import Regex
    from tokenizers.normalizers import Lowercase
    from tokenizers.pre_tokenizers import Split

    codes = [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)]
    every = "".join(map(chr, codes))

    def inside(others: str) -> str:
        runs = (span for _, span in Split(Regex(others), "removed").pre_tokenize_str(every))
        return "".join(f"\\U{ord(every[a]):08x}-\\U{ord(every[b - 1]):08x}" for a, b in runs)

    cased = [c for c in every if c != "\n"]
    lower = Lowercase().normalize_str("\n".join(cased)).split("\n")
    return inside(r"\P{L}+"), inside(r"\P{N}+"), inside(r"\S+"), {c: x for c, x in zip(cased, lower, strict=True) if c != x}


class WordSplitter:
    """Composes, lower-cases and splits text into words.

    ASCII text, text below U+10000 and any text have a pattern each: classes without wide
    characters are read in one step, those with them range by range.
    """

    def __init__(self, tables):
        letters, numbers, spaces, lower = tables
        self.lower = {ord(c): x for c, x in lower.items()}
        # Where this Python lower-cases otherwise, or by context, the table is used.
        other = [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x40000))) if c.lower() != lower.get(c, c) or c == "\u03a3"]
        classes = letters, numbers, spaces, "".join(f"\\U{ord(c):08x}-\\U{ord(c):08x}" for c in other)
        self.plain, _ = self._patterns(classes, 0x80)
        self.narrow, self.wide = self._patterns(classes, 0x10000), self._patterns(classes, 0x110000)
        self.composing = re.compile("[^\\x00-\u02ff]")  # below stands nothing that composes
        self.beyond = re.compile("[^\\x00-\uffff]")

    @staticmethod
    def _patterns(classes, limit: int) -> tuple[re.Pattern, re.Pattern]:
        """Of text whose characters are below ``limit``: its words, and what needs the table."""

        def below(inside: str) -> str:
            runs = [(int(a, 16), int(b, 16)) for a, b in re.findall(r"\\U(.{8})-\\U(.{8})", inside)]
            return "".join(f"\\U{a:08x}-\\U{min(b, limit - 1):08x}" for a, b in runs if a < limit)

        letters, numbers, spaces, other = map(below, classes)
        return re.compile(f"[{letters}]+|[{numbers}]|{SHORT}|[^{spaces}{letters}{numbers}]+"), re.compile(f"[{other}]" if other else "(?!)")

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.plain.findall(text.lower())
        if self.composing.search(text):
            from tokenizers.normalizers import NFC

            text = NFC().normalize_str(text)
        words, other = self.wide if self.beyond.search(text) else self.narrow
        return words.findall(text.translate(self.lower) if other.search(text) else text.lower())


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b], extra = chr(extra), extra + 1
    return [out[b] for b in range(256)]


class TrieEncoder:
    """Encodes words under a merge list with word ends."""

    def __init__(self, spec: dict, tables=None):
        model = spec["model"]
        self.splitter = WordSplitter(tables or character_tables())
        self.names: dict[int, str] = {i: s for s, i in model["vocab"].items()}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: s for s, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # A word is a string over one character per symbol; a last symbol, which carries the
        # word end, is its character moved up by 0x10000.
        self.byte = byte_alphabet()
        self.table = {b: c for b, c in enumerate(self.byte)}
        packed = lambda s: s[: -len(END) - 1] + chr(ord(s[-len(END) - 1]) + 0x10000) if s.endswith(END) and len(s) > len(END) else s
        self.ids: dict[str, int] = {packed(s): i for s, i in model["vocab"].items()}
        # Every end of a token: its id, or -1 where only longer tokens end so.
        self.tails: dict[str, int] = {s[k:]: -1 for s in self.ids for k in range(1, len(s))} | self.ids
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = self.ids[packed(left)], self.ids[packed(right)]
            made = self.ids[packed(left + right)]
            self.rank[a, b] = rank
            self.parts.setdefault(made, (a, b, rank))
        self.size = {i: len(s) for s, i in self.ids.items()}
        self._apart: dict[tuple[int, int], bool] = {}
        self._edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}

    def _edge(self, token: int, right_end: bool) -> list[tuple[int, int]]:
        """Pieces at one end of a token, smallest first, each with the rank that ends it."""
        key = (token, right_end)
        if key not in self._edges:
            out, end = [], 1 << 60
            while True:
                out.append((token, end))
                if token not in self.parts:
                    break
                left, right, end = self.parts[token]
                token = right if right_end else left
            self._edges[key] = out[::-1]
        return self._edges[key]

    def apart(self, left: int, right: int) -> bool:
        """True if no merge joins pieces across the boundary of the two tokens."""
        key = (left, right)
        known = self._apart.get(key)
        if known is not None:
            return known
        a, b = self._edge(left, True), self._edge(right, False)
        i = j = 0
        stay = True
        while True:
            (x, x_end), (y, y_end) = a[i], b[j]
            across = self.rank.get((x, y))
            # Of equal ranks the leftmost merge comes first.
            if across is not None and across < x_end and across <= y_end:
                stay = False
                break
            if i == len(a) - 1 and j == len(b) - 1:
                break
            if x_end <= y_end:
                i += 1
            else:
                j += 1
        if len(self._apart) > 2_000_000:
            self._apart.clear()
        self._apart[key] = stay
        return stay

    def symbols(self, word: str) -> str:
        s = word if word.isascii() and word.isprintable() else word.encode("utf-8").decode("latin-1").translate(self.table)
        return s[:-1] + chr(ord(s[-1]) + 0x10000)

    def encode_words(self, words) -> dict[str, list[int]]:
        """Token ids of each distinct non-empty word."""
        tails, size, whole, known, apart = self.tails.get, self.size, self._whole, self._apart.get, self.apart
        out: dict[str, list[int]] = {}
        before, last = "", [-1]  # last[d]: state of the node at depth d of the current path
        paths = {self.symbols(w): w for w in words}
        for path in sorted(paths):
            d = 0
            for x, y in zip(before, path, strict=False):
                if x != y:
                    break
                d += 1
            del last[d + 1 :]
            while d < len(path):
                d += 1
                state, start = -2, d - 1
                while start >= 0:
                    token = tails(path[start:d])
                    if token is None:
                        break
                    if token >= 0:
                        if start == 0:
                            fits = whole(token)
                        elif (left := last[start]) < 0:
                            fits = False
                        elif (fits := known((left, token))) is None:
                            fits = apart(left, token)
                        if fits:
                            state = token
                            break
                    start -= 1
                last.append(state)
            before = path
            tokens, d = [], len(path)
            while d:
                tokens.append(last[d])
                d -= size[last[d]]
            out[paths[path]] = tokens[::-1]
        return out

    def _whole(self, token: int) -> bool:
        """A token is the encoding of its own text if its two parts are theirs and meet."""
        made = self.parts.get(token)
        if made is None:
            return True
        key = (-1, token)
        known = self._apart.get(key)
        if known is None:
            # The parts stay whole until the rank that joins them.
            a, b = self._edge(made[0], True), self._edge(made[1], False)
            i = j = 0
            known = self._whole(made[0]) and self._whole(made[1])
            while known:
                (x, x_end), (y, y_end) = a[i], b[j]
                if i == len(a) - 1 and j == len(b) - 1:
                    break
                across = self.rank.get((x, y))
                if across is not None and across < x_end and across <= y_end:
                    known = False
                elif x_end <= y_end:
                    i += 1
                else:
                    j += 1
            self._apart[key] = known
        return known

    def words_in(self, text: str) -> list[str]:
        """Words of a text in order; a special token's own string stands for itself."""
        out: list[str] = []
        for part in self.split_special.split(text) if self.split_special and "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.splitter.split(part)
        return out


def pieces(text: str, size: int = 1_000_000):
    """Cuts of a long text, each ending before an ASCII space or line end."""
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(" ", start + 1, start + size), text.rfind("\n", start + 1, start + size))
        if cut < 0:
            cut = min((k for k in (text.find(" ", start + size), text.find("\n", start + size)) if k >= 0), default=len(text))
        yield text[start:cut]
        start = cut
    yield text[start:]


class TextEncoder:
    """Encodes texts, keeping the encodings of up to ``cache_words`` words."""

    def __init__(self, path: str, cache_words: int = 500_000, tables=None):
        with open(path, encoding="utf-8") as f:
            self.encoder = TrieEncoder(json.load(f), tables)
        self.cache_words = cache_words
        self.known: dict[str, tuple[str, str]] = {}

    def learn(self, words: set[str]) -> None:
        new = {w for w in words if w not in self.known}
        if len(self.known) + len(new) > self.cache_words:
            self.known, new = {}, words
        special, names = self.encoder.special, self.encoder.names
        for w in new & special.keys():
            self.known[w] = (str(special[w]), w)
        for w, ids in self.encoder.encode_words(new - special.keys()).items():
            self.known[w] = (" ".join(map(str, ids)), " ".join([names[i] for i in ids]))

    def rows(self, texts: list[str | None]):
        """(n_tokens, ids_sha256, decoded_sha256) of each text."""
        group, size = [], 0
        for t in texts:
            group.append(t or "")
            size += len(group[-1])
            if size >= 4_000_000:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]):
        if all(len(t) <= 1_000_000 for t in texts):
            words = [self.encoder.words_in(t) for t in texts]
            self.learn({w for ws in words for w in ws})
            for ws in words:
                yield self._hashes([ws])
            return
        for t in texts:
            yield self._hashes(self._read(t))

    def _read(self, text: str):
        for part in pieces(text):
            words = self.encoder.words_in(part)
            self.learn(set(words))
            yield words

    def _hashes(self, parts) -> tuple[int, str, str]:
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        known = self.known
        for words in parts:
            if not words:
                continue
            known = self.known
            pairs = [known[w] for w in words]
            text = " ".join([p[0] for p in pairs])
            ids.update((b" " if n else b"") + text.encode())
            decoded.update((b" " if n else b"") + " ".join([p[1] for p in pairs]).encode())
            n += text.count(" ") + 1
        return n, ids.hexdigest(), decoded.hexdigest()


def _encoder(path: str, tables) -> TextEncoder:
    """A task's own encoder, so that a worker that goes on to other work keeps none of it; a
    vocabulary file sent with the job is found by its name."""
    return TextEncoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), tables=tables)


def bpe_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of the decoded text.

    ``vocabulary`` is the path of a tokenizer file on every node, or the name of a file
    that was added to the session with addFile.
    """
    tables = character_tables()

    def run(batches):
        encoder = _encoder(vocabulary, tables)
        for b in batches:
            rows = list(encoder.rows(b.column(1).to_pylist()))
            n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the token ids of each text."""
    tables = character_tables()

    def run(batches):
        e = _encoder(vocabulary, tables)
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                ids: list[int] = []
                for words in e._read(t or ""):
                    ids += [int(i) for w in words for i in e.known[w][0].split()]
                out.append(ids)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the vocabulary strings of the ids, joined by a space."""
    tables = character_tables()

    def run(batches):
        names = _encoder(vocabulary, tables).encoder.names
        for b in batches:
            out = [" ".join([names[i] for i in ids or ()]) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
