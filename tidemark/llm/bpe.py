"""Byte-pair encoding by per-prefix dynamic programming, and decoding.

For every prefix of a pre-token the encoding of that prefix ends in one certain token. A suffix automaton of the
vocabulary gives, byte by byte, the tokens that end there; the one that may follow the stored last token of the prefix
before it (the pair re-encodes as itself) is stored. Following the stored tokens back from the end gives the ids.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._ids import masked, named, unmasked
from ._store import small_batches
from ._chunks import Kept, stretches

#: Entries, of the younger half, of the store of encoded stretches in a Python worker (about 100 MB) and of that of token pairs; pre-tokens and their beginnings have half as many.
KEPT = 300_000
#: Bytes of a beginning: words that share one go on from its stored last tokens.
BEGUN = 6
NEVER = 1 << 60
#: The pre-token pattern of the byte-level vocabulary, with white space as Unicode has it (fixed value).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


#: Latin letters and ASCII signs after them: two pre-tokens at most, which the pattern needn't look for. No apostrophe, as it may begin a contraction.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable ones stand for themselves, the rest follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Automaton:
    """Suffix automaton of all tokens: states are followed by one byte; each knows the tokens that end there."""

    def __init__(self, tokens: dict[bytes, int]):
        self.step: dict[int, int] = {}  # state * 256 + byte -> state
        self.length, self.link, own = [0], [-1], [[]]
        edges: list[dict[int, int]] = [{}]

        def new(length: int, link: int, out: dict[int, int]) -> int:
            self.length.append(length), self.link.append(link), own.append([]), edges.append(out)
            return len(self.length) - 1

        for word in tokens:
            last = 0
            for byte in word:
                if (q := edges[last].get(byte)) is not None:
                    if self.length[q] == self.length[last] + 1:
                        last = q
                        continue
                    copy = new(self.length[last] + 1, self.link[q], dict(edges[q]))
                    self.link[q] = copy
                    p = last
                    while p >= 0 and edges[p].get(byte) == q:
                        edges[p][byte] = copy
                        p = self.link[p]
                    last = copy
                    continue
                now = new(self.length[last] + 1, 0, {})
                p = last
                while p >= 0 and byte not in edges[p]:
                    edges[p][byte] = now
                    p = self.link[p]
                if p >= 0:
                    q = edges[p][byte]
                    if self.length[q] == self.length[p] + 1:
                        self.link[now] = q
                    else:
                        copy = new(self.length[p] + 1, self.link[q], dict(edges[q]))
                        self.link[q] = self.link[now] = copy
                        while p >= 0 and edges[p].get(byte) == q:
                            edges[p][byte] = copy
                            p = self.link[p]
                last = now
        for state, out in enumerate(edges):
            for byte, to in out.items():
                self.step[state << 8 | byte] = to
        for word, token in tokens.items():
            state = 0
            for byte in word:
                state = self.step[state << 8 | byte]
            own[state].append((len(word), token))
        # Tokens that end in a state, longest first; those of shorter suffixes come from the suffix links.
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(own)
        for state in sorted(range(len(own)), key=self.length.__getitem__):
            self.ends[state] = (*sorted(own[state], reverse=True), *(self.ends[self.link[state]] if state else ()))


class Encoder:
    """The vocabulary of a tokenizers file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, letters = whole["model"], {c: b for b, c in enumerate(byte_letters())}
        self.special = {x["content"]: x["id"] for x in whole["added_tokens"]}
        self.split = regex.compile("|".join(f"({regex.escape(x)})" for x in sorted(self.special, key=len, reverse=True))) if self.special else None
        raw = lambda s: bytes(map(letters.__getitem__, s))
        ids = {raw(s): i for s, i in model["vocab"].items()}
        self.spelling: list[bytes] = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for s, i in ids.items():
            self.spelling[i] = s
        for s, i in self.special.items():
            self.spelling[i] = s.encode()
        self.size = list(map(len, self.spelling))
        self.decimal = [str(i) for i in range(len(self.spelling))]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> rank, merged
        self.parts: dict[int, tuple[int, int]] = {}  # merged -> pair
        for rank, (a, b) in enumerate(x.split(" ") if isinstance(x, str) else x for x in model["merges"]):
            a, b = raw(a), raw(b)
            self.rank[ids[a], ids[b]] = (rank, ids[a + b])
            self.parts.setdefault(ids[a + b], (ids[a], ids[b]))
        self.made = [self.rank[self.parts[i]][0] if i in self.parts else -1 for i in range(len(self.spelling))]
        self.single = [ids[bytes([b])] for b in range(256)]
        # A token that its own bytes don't lead to ends no prefix.
        reached = {s: i for s, i in ids.items() if len(s) == 1 or (i in self.parts and self.merged(s) == [i])}
        self.automaton = Automaton(reached)
        self.fits = Kept(self.compatible, KEPT)
        self.words = Kept(self.encode_word, KEPT // 2)
        self.begun = Kept(self.begin, KEPT // 2)
        self.pieces = Kept(self.encode_piece, KEPT)
        self.pattern = regex.compile(PATTERN)

    def merged(self, s: bytes) -> list[int]:
        """Plain merging, lowest rank first: what defines the encoding; used to test tokens only."""
        out = [self.single[b] for b in s]
        while len(out) > 1:
            ranks = [self.rank.get(pair, (NEVER, 0)) for pair in zip(out, out[1:], strict=False)]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k][0] == NEVER:
                break
            out[k : k + 2] = [ranks[k][1]]
        return out

    def compatible(self, pair: int) -> bool:
        """Whether the bytes of two tokens, one after the other, encode as just these two.

        Only the last part of the left token and the first part of the right one ever touch. Going back in time from both
        tokens whole, no two parts that touch may have a merge that comes before each is used up; of equal ranks the merge
        further left comes first."""
        x, y = pair >> 32, pair & 0xFFFFFFFF
        x_ends = y_ends = NEVER
        while True:
            found = self.rank.get((x, y))
            if found and found[0] < x_ends and found[0] <= y_ends:
                return False
            x_made, y_made = self.made[x], self.made[y]
            if x_made > y_made:
                x, x_ends = self.parts[x][1], x_made
            elif y_made >= 0:
                y, y_ends = self.parts[y][0], y_made
            else:
                return True

    def follow(self, s: bytes, last: list[int], state: int, matched: int) -> tuple[int, int]:
        """Add the last token of every further prefix of s to last, which holds those of the prefixes before; state and
        matched are where the automaton stands after them, and what is returned is where it stands at the end."""
        step, length, link, ends, fits = self.automaton.step, self.automaton.length, self.automaton.link, self.automaton.ends, self.fits
        i = len(last) - 1
        for byte in s[i:]:
            i += 1
            while (to := step.get(state << 8 | byte)) is None:
                state = link[state]
                matched = length[state]
            state = to
            matched += 1
            for size, token in ends[state]:
                if size <= matched and (size == i or fits[last[-size] << 32 | token]):
                    break
            last.append(token)
        return state, matched

    def begin(self, s: bytes) -> tuple[int, int, tuple[int, ...]]:
        """Where the automaton stands after s, and the last token of each prefix of it."""
        last = [0]
        return *self.follow(s, last, 0, 0), tuple(last)

    def encode_word(self, word: str) -> tuple[int, ...]:
        s = word.encode()
        state, matched, last = self.begun[s[:BEGUN]] if len(s) > BEGUN else (0, 0, (0,))
        last = list(last)
        self.follow(s, last, state, matched)
        out, i, size = [], len(s), self.size
        while i:
            token = last[i]
            out.append(token)
            i -= size[token]
        out.reverse()
        return tuple(out)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """A stretch that lacks the space before it."""
        if plain := PLAIN(piece):
            letters, signs = plain.groups()
            return self.words[" " + letters] + self.words[signs] if signs else self.encode_word(" " + letters)
        return self.encode_stretch(" " + piece)

    def encode_stretch(self, stretch: str) -> tuple[int, ...]:
        return tuple(token for word in self.pattern.findall(stretch) for token in self.words[word])

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens become their ids, nothing is added."""
        out: list[int] = []
        for part in self.split.split(text) if self.split and self.split.search(text) else (text,):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                first, *rest = stretches(part)
                out += self.encode_stretch(first)
                out.extend(chain.from_iterable(map(self.pieces.__getitem__, rest)))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder in a Python worker."""
    return Encoder(path)


SCHEMA = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """(id, ids, decoded) of every row: whole texts, null counting as empty (no ids). Rows that repeat stay apart, a
    null id stays null, and an empty table gives an empty result. ids=False leaves the arrays and texts out and gives
    n_tokens and the digests of both instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                tokens = own.encode(text or "")
                decoded = own.decode(tokens)
                rows.append((tokens, decoded) if ids else (len(tokens), hashlib.sha256(",".join(map(own.decimal.__getitem__, tokens)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            names = ["ids", "decoded"] if ids else ["n_tokens", "ids_sha256", "decoded_sha256"]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    small_batches(docs.sparkSession)
    kind = "id long, ids array<int>, decoded string" if ids else SCHEMA
    rows = docs.select(masked(named(id_col)).alias("id"), named(text_col).alias("text"))
    return rows.mapInPandas(run, kind).withColumn("id", unmasked(F.col("id"))).withColumnRenamed("id", id_col)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """n_tokens and digests of the ids and of the decoded text, with the public byte-level vocabulary."""
    import public_tokenizers

    return bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=False)
