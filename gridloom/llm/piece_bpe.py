"""Encoding and decoding with a SentencePiece BPE model by vectorised merge rounds.

A text is normalised as the model says and cut into words where no piece of the model can cross: before a space mark
that follows another character, and, inside the rounds, between two characters that follow one another in no piece. The
distinct words of a batch go through the rounds together: symbols of all words lie in one flat array; each round takes
the best pair of every word (a segmented minimum of the pairs' ranks), merges its leftmost occurrences in all words at
once and compacts the array, until no word has a pair left. A word whose merges would open a pair
at least as good as the one being merged takes its first merge only, so that the order is that of one
merge at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bounded, text_of

SPACE = "▁"
WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
NO_RANK = np.int64(1) << 40

#: Words whose ids a task keeps, in each of two generations: a full table becomes the old one, and what is met again moves up.
KEPT_WORDS = 250_000

#: Words that take the rounds together.
ROUND_WORDS = 10_000


class PieceModel:
    """The pieces of a model as arrays: symbols, mergeable pairs and their ranks."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        if any(sp.is_unused(i) for i in plain):
            raise ValueError("models with unused pieces are not supported")
        if any(SPACE in self.names[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece of this model spans words")
        self.byte_ids = {int(self.names[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i in range(size) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        self.identity = all(sp.normalize(x) == self._marked(x) for x in ("a  b ", " éＡ", "\tx\n"))

        ids = {self.names[i]: i for i in plain}
        inner = {c for p in ids if len(p) > 1 for c in p} - set(ids)
        self.symbols = ids | {c: size + k for k, c in enumerate(sorted(inner))}
        scores = np.array([sp.get_score(i) for i in range(size)], np.float64)
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in plain}, reverse=True))}
        pairs = {}
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = (order[scores[i]], i)
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair_keys.tolist()] + [NO_RANK], np.int64)
        self.pair_into = np.array([pairs[k][1] for k in self.pair_keys.tolist()] + [0], np.int64)
        follow = sorted({(ord(a) << 32) | ord(b) for p in ids for a, b in zip(p, p[1:])})
        self.follow = np.array(follow, np.int64)
        self.shown = [p.replace(SPACE, " ") for p in self.names]
        self.digits = [str(i) for i in range(size)]
        self.special = frozenset({*self.byte_of, *self.silent, self.unknown})
        self.kept: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}

    @staticmethod
    def _marked(text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def words(self, text: str) -> list[str]:
        """The words of a text, each without the space mark that it begins with."""
        if self.identity and text and "  " not in text and SPACE not in text and text[0] != " " != text[-1]:
            return text.split(" ")
        marked = self._marked(text) if self.identity else self.library.normalize(text)
        return [w[1:] for w in WORDS.findall(marked)]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (left << 32) | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        at = np.where(self.pair_keys[at] == key, at, len(self.pair_keys)) if len(self.pair_keys) else np.zeros_like(key)
        return self.pair_rank[at], self.pair_into[at]

    def merge(self, words: list[str]) -> list[list[int]]:
        """The ids of each of ``words`` (none empty)."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        # A part is a run of characters that follow one another in some piece; no merge crosses its ends.
        pair = (code[:-1].astype(np.int64) << 32) | code[1:]
        at = np.minimum(np.searchsorted(self.follow, pair), max(0, len(self.follow) - 1))
        joined = (self.follow[at] == pair) & (owner[1:] == owner[:-1]) if len(self.follow) else np.zeros(len(pair), bool)
        begins = np.r_[True, ~joined]
        word = np.cumsum(begins) - 1
        done: list[list[int]] = [[] for _ in range(int(word[-1]) + 1)]
        owners = owner[begins].tolist()
        seen, where = np.unique(code, return_inverse=True)
        first = [self._first(chr(c)) for c in seen.tolist()]
        symbol = np.array([x[0] for x in first], np.int64)[where]
        wide = np.array([len(x) for x in first])[where]
        if (wide > 1).any():  # the bytes of characters that no piece holds
            symbol, word = np.repeat(symbol, wide), np.repeat(word, wide)
            start = np.cumsum(wide) - wide
            for k in range(1, int(wide.max())):
                more = wide > k
                symbol[start[more] + k] = np.array([x[k] if len(x) > k else 0 for x in first])[where[more]]
        rank = np.full(len(symbol), NO_RANK)
        into = np.zeros(len(symbol), np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside], into[inside] = self._ranks(symbol[inside], symbol[inside + 1])

        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(word)])
            least = np.minimum.reduceat(rank, starts)
            over = least == NO_RANK
            if over.any():
                gone = np.repeat(over, lengths)
                flat = symbol[gone].tolist()
                ends = np.cumsum(lengths[over])
                inner = bool(flat) and max(flat) >= len(self.names)
                for k, s, e in zip(word[starts[over]].tolist(), (ends - lengths[over]).tolist(), ends.tolist(), strict=True):
                    done[k] = self._ids(flat[s:e]) if inner else flat[s:e]
                stay = ~gone
                symbol, word, rank, into = symbol[stay], word[stay], rank[stay], into[stay]
                if not len(symbol):
                    break
                starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                lengths = np.diff(np.r_[starts, len(word)])
                least = least[~over]
            segment = np.repeat(np.arange(len(starts)), lengths)
            best = least[segment]
            hit = rank == best
            # Of pairs that overlap, every second one from the left.
            at = np.flatnonzero(hit)
            first = np.r_[True, (at[1:] != at[:-1] + 1) | (segment[at[1:]] != segment[at[:-1]])]
            run = np.flatnonzero(first)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            at = self._in_order(at, symbol, into, segment, best)
            symbol[at] = into[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbol, word, rank, into = symbol[keep], word[keep], rank[keep], into[keep]
            touched = place[at]
            marked = np.zeros(len(symbol), bool)
            marked[touched] = marked[touched[touched > 0] - 1] = True
            touched = np.flatnonzero(marked)
            rank[touched], into[touched] = NO_RANK, 0
            touched = touched[touched + 1 < len(symbol)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched], into[touched] = self._ranks(symbol[touched], symbol[touched + 1])
        found: list[list[int]] = [[] for _ in words]
        for k, part in zip(owners, done, strict=True):
            found[k] += part
        return found

    def _in_order(self, at, symbol, into, segment, best) -> np.ndarray:
        """``at`` less the merges that may have to wait for a pair which an earlier one opens."""
        later = np.r_[False, segment[at[1:]] == segment[at[:-1]]]
        if not later.any():
            return at
        last = len(symbol) - 1
        made = into[at]
        beside = np.r_[(at[1:] == at[:-1] + 2) & later[1:], False]  # the next merge starts where this ends
        left, right = np.maximum(at - 1, 0), np.minimum(at + 2, last)
        opened = np.full(len(at), NO_RANK)
        has_right = (at + 2 <= last) & (segment[right] == segment[at])
        opened[has_right] = self._ranks(made[has_right], symbol[right[has_right]])[0]
        after = np.r_[False, beside[:-1]]
        has_left = (at > 0) & (segment[left] == segment[at])
        left_symbol = np.where(after, np.r_[0, made[:-1]], symbol[left])
        opened[has_left] = np.minimum(opened[has_left], self._ranks(left_symbol[has_left], made[has_left])[0])
        risky = np.zeros(int(segment[-1]) + 1, bool)
        risky[segment[at[opened <= best[at]]]] = True
        return at[~(later & risky[segment[at]])]

    def _first(self, c: str) -> list[int]:
        """The symbols that a character begins as: its own, or ids that no pair holds."""
        if c in self.symbols:
            return [self.symbols[c]]
        return [self.byte_ids[b] for b in c.encode()] if self.byte_ids else [self.unknown]

    def _ids(self, symbols: list[int]) -> list[int]:
        """Ids of ``symbols``, among them characters that stand in pieces without being one."""
        size = len(self.names)
        back = {k: c for c, k in self.symbols.items() if k >= size}
        plain = [[s] if s < size else [self.byte_ids[b] for b in back[s].encode()] or [self.unknown] for s in symbols]
        return [i for x in plain for i in x]

    def _learn(self, words: list[str]) -> None:
        """Put (ids joined by commas, decoded text) of ``words`` into ``kept``."""
        if len(self.kept) > KEPT_WORDS:
            self.old, self.kept = self.kept, {}
        kept, old, new = self.kept, self.old, []
        for w in set(words):
            if w in old:
                kept[w] = old[w]
            elif w not in kept:
                new.append(w)
        for start in range(0, len(new), ROUND_WORDS):
            part = new[start : start + ROUND_WORDS]
            for w, ids in zip(part, self.merge([SPACE + w for w in part]), strict=True):
                kept[w] = (",".join(map(self.digits.__getitem__, ids)), self._surface(ids))

    def _surface(self, ids: list[int]) -> str:
        if self.special.isdisjoint(ids):
            return "".join(map(self.shown.__getitem__, ids))
        out, held = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i is not None and i not in self.silent:
                out.append(" ⁇ " if i == self.unknown else self.shown[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: pieces joined, space marks read as spaces, the leading one dropped."""
        return self._unmarked(self._surface(ids))

    @staticmethod
    def _unmarked(text: str) -> str:
        return text[1:] if text.startswith(" ") else text

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in next(self.digest([text]))[0].split(",") if i]

    def digest(self, texts: list[str]) -> Iterator[tuple[str, int, str]]:
        """(ids joined by commas, their number, decoded text) of each of ``texts``, whose words go through together."""
        cut = [self.words(text) for text in texts]
        found = [list(map(self.kept.get, words)) for words in cut]
        missing = [w for words, rows in zip(cut, found, strict=True) if None in rows for w, r in zip(words, rows, strict=True) if r is None]
        if missing:
            self._learn(missing)
        for words, rows in zip(cut, found, strict=True):
            if None in rows:
                rows = [r or self.kept[w] for w, r in zip(words, rows, strict=True)]
            ids, shown = zip(*rows, strict=True) if rows else ((), ())
            joined = ",".join(ids)
            yield joined, joined.count(",") + 1 if joined else 0, self._unmarked("".join(shown))


def encode_texts(docs: DataFrame, model_file: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    Ids are without begin and end marks. Null text counts as empty: no ids, and the empty text back.
    Repeated rows and null ids are encoded like any other; other columns are not looked at; an empty
    table gives an empty table. Each row is done on its own: nothing is shuffled.
    """
    import pyarrow as pa

    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def encode(batches):
        import hashlib

        model = PieceModel(model_file)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in bounded(batches):
            texts = batch.column(1).to_pylist()
            ids, counts, hashes, decoded = [], [], [], []
            # Texts of about a million characters at a time.
            ends = np.searchsorted(np.cumsum([len(t) for t in texts]), np.arange(1 << 20, sum(map(len, texts)), 1 << 20), "right")
            for group in (texts[a:b] for a, b in zip([0, *ends], [*ends, len(texts)], strict=True)):
                for joined, n, text in model.digest(group):
                    counts.append(n)
                    hashes.append(sha(joined))
                    decoded.append(sha(text))
                    if with_ids:
                        ids.append([int(i) for i in joined.split(",")] if joined else [])
            columns = [batch.column(0), counts, hashes, decoded] + [ids] * with_ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) if isinstance(c, list) else c for c, (_, t) in zip(columns, fields, strict=True)],
                names=[n for n, _ in fields],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(encode, schema)
