"""Exact BPE encoding and decoding by per-prefix dynamic programming.

The vocabulary becomes an automaton over its tokens (a trie with suffix links):
after each character of a word it names every token that ends there, longest
first.  For each prefix of the word exactly one token can be the last one of the
prefix's encoding: the token ``t`` whose rest prefix ends, by the same rule, in a
token ``p`` such that merging never crosses the border between ``p`` and ``t``.
That token is stored per prefix, and following the stored tokens back from the
end of the word yields the ids, in time linear in the word.

The border test compares the tokens' *spines*: while ``p`` is built by merges,
its right edge runs through a chain of tokens, each replaced at the rank of the
merge that consumes it; likewise the left edge of ``t``.  A merge across the
border happens iff some pair of the two chains has a merge rule that comes
before both ends' replacements (leftmost first among equal ranks).

Files: the JSON of the public ``tokenizers`` library with a BPE model, end-of-word
suffix, byte-level alphabet, the pattern-splitting pre-tokenizer and NFC /
white space / lower-case normalisers.  Encoding equals that library's
``encode(text, add_special_tokens=False)``, decoding its
``decode(ids, skip_special_tokens=False)``.

Defined results: null text is the empty text (no ids); an empty table gives no
rows; repeated rows are encoded alike; texts are encoded whole, whatever their
length; only the two named columns of the input are read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastespark.llm.common import give_back, hold, make_room, prepare

#: Words remembered by one Python worker, and transitions and border tests that its encoder has met; the memory of a task is
#: bounded by them.
CACHED_WORDS = 200_000
CACHED_STEPS = 100_000
CACHED_PAIRS = 200_000
#: Marks the end of a word inside the automaton.
END = "\x00"
#: Keys of transitions and of token pairs are one integer: the second part takes so many bits.
BITS = 21

# Unicode White_Space, which is what the file's patterns mean by \s
SPACE = "\t-\r \x85\xa0  -     　"
# Code points that this Python's tables have as letters or numbers and the tokenizers library's have not
NO_LETTER_OR_NUMBER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3"
    "\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    "\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96"
    "\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f")
# Marks that composition in the library's tables neither moves nor joins
FIXED_MARKS = (
    "\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c\U00010d24-\U00010d27"
    "\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e"
    "\U00011839-\U0001183a\U00011930\U0001193d-\U0001193e\U00011943\U000119e0\U00011a34\U00011a47\U00011a99\U00011d42"
    "\U00011d44-\U00011d45\U00011d97\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae"
    "\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef")
# Lower forms that the library's tables have beyond this Python's
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
         **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
_MARK = regex.compile(f"([{FIXED_MARKS}])")
_ODD = regex.compile(f"[{NO_LETTER_OR_NUMBER}]")


def _latin(text: str) -> bool:
    """No character beyond U+00FF, where all tables agree."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the others for U+0100 onwards in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PrefixEncoder:
    """Encodes and decodes with one tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or spec.get("decoder"):
            raise ValueError("a BPE file with an end-of-word suffix and no decoder is needed")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.plain_words = regex.compile(split.replace(r"[^\s", f"[^{SPACE}"))
        # letters, numbers and white space as the library's tables have them
        kinds = {"[\\p{L}]": f"[\\p{{L}}--[{NO_LETTER_OR_NUMBER}]]", "[\\p{N}]": f"[\\p{{N}}--[{NO_LETTER_OR_NUMBER}]]",
                 "[^\\s\\p{L}\\p{N}]": f"[[^{SPACE}\\p{{L}}\\p{{N}}]||[{NO_LETTER_OR_NUMBER}]]"}
        for plain, exact in kinds.items():
            split = split.replace(plain, exact)
        self.words = regex.compile(split, regex.VERSION1)
        self.byte = byte_alphabet()
        self._merges(model["merges"])
        self._automaton()
        self.decimal = [str(i) for i in range(max(self.token) + 1)]
        # the ids of a word, four bytes each
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- the model ---------------------------------------------------------

    def _merges(self, merges: list) -> None:
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}          # token -> left, right (a key of ``rank``)
        self.made = array("i", [0]) * (max(self.token) + 1)  # token -> rank of the merge that makes it
        for r, m in enumerate(merges):
            left, right = m if isinstance(m, list) else m.split(" ")
            pair, t = (self.vocab[left], self.vocab[right]), self.vocab[left + right]
            self.rank[pair] = r
            if t not in self.parts:
                self.parts[t], self.made[t] = pair, r
        self.never = len(merges) + 1
        # tokens that encoding can produce: atoms, and those whose parts meet undisturbed
        self.usable = bytearray(len(self.made))
        for t in self.vocab.values():
            if t not in self.parts:
                self.usable[t] = True
        for t in sorted(self.parts, key=self.made.__getitem__):
            a, b = self.parts[t]
            if self.usable[a] and self.usable[b] and self.border_holds(a, b, self.made[t]):
                self.usable[t] = True

    def _spine(self, t: int, side: int) -> list[tuple[int, int]]:
        """The tokens along one edge of ``t`` (0: left, 1: right), the outermost first, each with the rank of the
        merge that replaces it."""
        chain, until, parts = [], self.never, self.parts
        while True:
            chain.append((t, until))
            p = parts.get(t)
            if p is None:
                return chain
            t, until = p[side], self.made[t]

    def border_holds(self, a: int, b: int, before: int | None = None) -> bool:
        """No merge crosses the border between ``a`` and ``b`` (with ``before``: none of a smaller rank)."""
        rank = self.rank
        left = self._spine(b, 0)
        for x, x_until in self._spine(a, 1):
            for y, y_until in left:
                r = rank.get((x, y))
                if r is not None and r < x_until and r <= y_until and (before is None or r < before):
                    return False
        return True

    def _automaton(self) -> None:
        """Trie with suffix links, as flat tables: ``trie`` has its steps by state and character, ``own`` the token that a state
        spells (-1: none) and ``ends`` the nearest state along the suffix links, itself included, that spells one (0: none)."""
        n = len(self.suffix)
        self.length = array("i", [0]) * len(self.made)
        self.trie: dict[int, int] = {}
        trie, own, above, deep = self.trie, array("i", [-1]), array("q", [0]), array("i", [0])
        for text, t in self.vocab.items():
            if not self.usable[t]:
                continue
            if text.endswith(self.suffix):
                text = text[:-n] + END
            s = 0
            for depth, c in enumerate(text, 1):
                at = s << BITS | ord(c)
                s = trie.get(at)
                if s is None:
                    s = trie[at] = len(own)
                    own.append(-1)
                    above.append(at)
                    deep.append(depth)
            self.length[t] = len(text)
            own[s] = t
        link, ends = array("i", [0]) * len(own), array("i", [0]) * len(own)
        for s in sorted(range(1, len(own)), key=deep.__getitem__):
            parent, c = above[s] >> BITS, above[s] & (1 << BITS) - 1
            if parent:
                f = link[parent]
                while f and f << BITS | c not in trie:
                    f = link[f]
                link[s] = trie.get(f << BITS | c, 0)
            ends[s] = s if own[s] >= 0 else ends[link[s]]
        self.own, self.link, self.ends = own, link, ends
        self.fallen: dict[int, int] = {}
        self.borders: dict[int, bool] = {}

    def _fall(self, at: int) -> int:
        """The step that the trie lacks: that of the nearest state along the suffix links which has one."""
        s, c = at >> BITS, at & (1 << BITS) - 1
        to = None
        while s and to is None:
            s = self.link[s]
            to = self.trie.get(s << BITS | c)
        if len(self.fallen) >= CACHED_STEPS:
            self.fallen.clear()
        self.fallen[at] = to = to or 0
        return to

    def _border(self, pair: int) -> bool:
        """Whether the border between two tokens holds, remembered."""
        if len(self.borders) >= CACHED_PAIRS:
            self.borders.clear()
        self.borders[pair] = ok = self.border_holds(pair >> BITS, pair & (1 << BITS) - 1)
        return ok

    # -- words ---------------------------------------------------------------

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token: the dynamic programme over its prefixes."""
        symbols = word if word.isascii() and word.isprintable() else "".join([self.byte[b] for b in word.encode("utf-8")])
        last = [-1]                    # last token of each prefix; the end mark makes the final prefix
        trie, fallen, borders = self.trie, self.fallen, self.borders
        own, link, ends, lengths = self.own, self.link, self.ends, self.length
        state = 0
        for c in symbols + END:
            at = state << BITS | ord(c)
            state = trie.get(at)
            if state is None:
                state = fallen.get(at)
                if state is None:
                    state = self._fall(at)
            s = ends[state]
            while s:
                t = own[s]
                before = last[-lengths[t]]
                if before < 0:         # the word's start
                    break
                ok = borders.get(before << BITS | t)
                if ok or ok is None and self._border(before << BITS | t):
                    break
                s = ends[link[s]]
            last.append(t)
        out, length, i = [], self.length, len(symbols) + 1
        while i:
            t = last[i]
            out.append(t)
            i -= length[t]
        out.reverse()
        return out

    def _word(self, word: str) -> bytes:
        """Encode a word that the younger cache lacks.  The older generation is asked first; when
        the younger one is full it becomes the older, so frequent words stay known."""
        got = self.older.get(word)
        if got is None:
            got = array("i", self.encode_word(word)).tobytes()
        if len(self.cache) >= CACHED_WORDS // 2:
            self.older = dict(self.cache)
            self.cache.clear()
        self.cache[word] = got
        return got

    # -- texts -----------------------------------------------------------------

    def normalise(self, text: str) -> str:
        """NFC, white space to single spaces, lower case character by character
        (the capital sigma has one lower form, wherever it stands).  Only words
        are read afterwards, so white space needs no rewriting here."""
        if not text.isascii():
            if _latin(text):
                text = unicodedata.normalize("NFC", text)
            else:
                text = "".join([p if i % 2 else unicodedata.normalize("NFC", p) for i, p in enumerate(_MARK.split(text))])
                text = text.translate(LOWER).replace("Σ", "σ")
        return text.lower()

    def ids(self, text: str) -> array:
        """The ids of each word and special token in order."""
        if self.specials is None or "<|" not in text:
            return array("i", b"".join(self._pieces(text)))
        out, at = array("i"), 0
        for m in self.specials.finditer(text):
            out.frombytes(b"".join(self._pieces(text[at:m.start()])))
            out.append(self.special[m[0]])
            at = m.end()
        out.frombytes(b"".join(self._pieces(text[at:])))
        return out

    def _pieces(self, text: str) -> list[bytes]:
        cache, word = self.cache, self._word
        text = self.normalise(text)
        words = self.plain_words if text.isascii() or _latin(text) or not _ODD.search(text) else self.words
        return [cache.get(w) or word(w) for w in words.findall(text)]

    def encode(self, text: str | None) -> list[int]:
        return self.ids(text or "").tolist()

    def written(self, ids: array) -> str:
        """Decimal ids, joined by single spaces."""
        return " ".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids) -> str:
        return " ".join(map(self.token.__getitem__, array("i", ids)))


_LOADED: dict[str, PrefixEncoder] = {}


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _share(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes for the workers: 1.7 MB, whatever the size of the corpus."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoder(file: Broadcast) -> PrefixEncoder:
    """One encoder per worker process and file; the parsed file is not kept beside it."""
    key = hashlib.sha256(file.value).hexdigest()
    if key not in _LOADED:
        make_room("bpe")
        _LOADED.clear()
        _LOADED[key] = PrefixEncoder(json.loads(file.value))
        give_back()
        hold("bpe", _LOADED.clear)
    return _LOADED[key]


def encode_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                     keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (digests of the
    decimal ids joined by spaces and of the decoded text); ``keep_ids`` adds ``ids``
    (array<int>), ``keep_text`` the decoded text.

    ``tokenizer`` is the path of the file on the driver; its content (1.7 MB, whatever
    the size of the corpus) is broadcast.  No shuffle: each task encodes its own rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = _share(spark, tokenizer)
    # ids pass through Python as strings: long ids beside nulls would become floating point numbers
    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string" \
        + ", ids array<int>" * keep_ids + ", decoded string" * keep_text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(shared)
        for pdf in batches:
            n, ids_hash, text_hash, ids, texts = [], [], [], [], []
            for t in pdf["text"]:
                got = enc.ids(t or "")
                decoded = enc.decode(got)
                n.append(len(got))
                ids_hash.append(hashlib.sha256(enc.written(got).encode()).hexdigest())
                text_hash.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if keep_ids:
                    ids.append(np.array(got, dtype=np.int32))
                if keep_text:
                    texts.append(decoded)
            out = {"doc_id": pdf["doc_id"], "n_tokens": n, "ids_sha256": ids_hash, "decoded_sha256": text_hash}
            if keep_ids:
                out["ids"] = pd.Series(ids, dtype=object)
            if keep_text:
                out["decoded"] = texts
            yield pd.DataFrame(out)

    out = rows.mapInPandas(run, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def decode_ids(encoded: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its id arrays decode to (null ids: empty text)."""
    spark = encoded.sparkSession
    prepare(spark)
    shared = _share(spark, tokenizer)

    @F.pandas_udf("string")
    def decode(col: pd.Series) -> pd.Series:
        enc = _encoder(shared)
        return pd.Series([enc.decode(x) if x is not None else "" for x in col], dtype=object)

    return encoded.withColumn(out, decode(F.col(ids)))
