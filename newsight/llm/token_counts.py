"""Token counts by a two-tier lookup of pre-token lengths.

A word splits into the same tokens wherever it stands, so a text's count is a sum of
lengths of its pre-tokens. The first tier is a compact table of frequent pre-tokens and
their lengths, broadcast to all workers; the second is a cache in each worker, which
encodes a pre-token when it is missed. No pre-token is ever shuffled: the table comes from
bounded sketches (``approx_top_k``) over the first rows of every partition, and only
sketches move. The tables decide how fast a count is found, never what it is.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import bounded_batches, keyed_text

# the broadcast table holds so many pre-tokens at most, each of at most so many characters
TABLE_WORDS, WORD_CHARS = 16_384, 40
# rows of each partition that are looked at for the table
SEED_ROWS = 64
# pre-tokens tracked by a sketch, and sketches merged side by side before the last merge
SKETCH_WORDS, LANES = 32_768, 64
# a worker's cache goes back to the broadcast table when it holds so many more
CACHE_WORDS = 500_000
# characters whose lower case, normal form and classes are known to agree with the tokenizers
# library (tested one by one); other texts are split by the library itself
_PLAIN_TEXT = r"[\t\n\r\x20-\x7e¡-ɏ‐-…€]*"
# the pre-token pattern of the vocabulary file (fixed value)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _plain_splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of the pattern for plain texts, with letters and numbers as plain classes."""
    marks = sorted({low for c in range(0x2030) if c < 0x250 or c > 0x2000 for low in chr(c).lower()})
    for name, initial in ((r"\p{L}", "L"), (r"\p{N}", "N")):
        members = "".join(c for c in marks if unicodedata.category(c).startswith(initial))
        pattern = pattern.replace(f"[{name}]", f"[{members}]").replace(name, members)
    return re.compile(pattern).findall


class PreTokens:
    """Pre-tokens of a text, and the number of tokens of a pre-token.

    ``plain_pattern`` splits the lower-cased text for texts of common Latin characters. All
    others, and every text if no pattern is given, are normalised and split by the library.
    """

    def __init__(self, tokenizer_path: str, plain_pattern: str | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.plain = re.compile(_PLAIN_TEXT).fullmatch if plain_pattern else lambda text: None
        self.split_plain = _plain_splitter(plain_pattern or "")
        # words of plain letters that the pre-tokenizer leaves as they are go straight to the model
        letters = "abcdefghijklmnopqrstuvwxyz"
        self.letters_stay = [p for p, _ in self._pieces(letters)] == [letters]

    def __call__(self, text: str) -> list[str] | None:
        """None: the text holds an added token, which only the whole library cuts out."""
        if any(s in text for s in self.special):
            return None
        if self.plain(text):
            return self.split_plain(text.lower())
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        # pieces in the characters of the text, which is also how the table holds them
        return [text[a:b] for _, (a, b) in self._pieces(text)]

    def _pieces(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        if self.library.pre_tokenizer is None:
            return [(text, (0, len(text)))] if text else []
        return self.library.pre_tokenizer.pre_tokenize_str(text)

    def length(self, word: str) -> int:
        if self.letters_stay and word.isascii() and word.isalpha() and word.islower():
            return len(self.model.tokenize(word))
        return sum(len(self.model.tokenize(piece)) for piece, _ in self._pieces(word))

    def count_whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)


class LengthCache(dict):
    """Second tier: starts as the broadcast table and encodes what it misses.

    Pre-tokens of more than ``WORD_CHARS`` characters are encoded each time, so the cache has
    a bounded size.
    """

    def __init__(self, table: dict[str, int], encode: Callable[[str], int], room: int = CACHE_WORDS):
        super().__init__(table)
        self.table, self.encode, self.room, self.misses = table, encode, room, 0

    def __missing__(self, word: str) -> int:
        self.misses += 1
        n = self.encode(word)
        if len(word) <= WORD_CHARS:
            if len(self) >= len(self.table) + self.room:
                self.clear()
                self.update(self.table)
            self[word] = n
        return n


def frequent_lengths(
    docs: DataFrame, tokenizer_path: str, plain_pattern: str | None = None,
    table_words: int = TABLE_WORDS, seed_rows: int = SEED_ROWS, text_col: str = "text",
) -> dict[str, int]:
    """First tier: lengths of pre-tokens that are frequent in the first rows of each partition.

    At most ``table_words`` reach the driver. Zero of either bound gives an empty table.
    """
    if not table_words or not seed_rows:
        return {}
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, left = PreTokens(tokenizer_path, plain_pattern), seed_rows
        for batch in batches:
            for text in batch.column(0).slice(0, left).to_pylist():
                words = [w for w in split(text) or [] if len(w) <= WORD_CHARS]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])
            left -= min(left, batch.num_rows)
            if not left:
                return  # the rest of the partition is not read

    words = texts.mapInArrow(run, "word string").withColumn("lane", F.spark_partition_id() % LANES)
    sketches = words.groupBy("lane").agg(
        F.expr(f"approx_top_k_accumulate(word, {SKETCH_WORDS})").alias("sketch")
    )
    # grouped by a constant, so that no sketches at all give no row
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {SKETCH_WORDS})").alias("sketch")
    )
    top = merged.select(F.expr(f"approx_top_k_estimate(sketch, {table_words})").alias("top")).first()
    split = PreTokens(tokenizer_path, plain_pattern)
    return {w.item: split.length(w.item) for w in (top["top"] if top else [])}


def count_tokens(
    docs: DataFrame, tokenizer_path: str, plain_pattern: str | None = None, limit: int = 2048,
    table: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of each row, whole texts.

    Counts are those of the tokenizers library without begin, end or other added tokens;
    strings of its special tokens inside a text are those tokens, as is the library's default.
    A null text is empty and has no tokens; every row gives one row, repeated rows, rows with a
    null id and texts of any length included. An empty table gives an empty result. Other
    columns play no part. ``table`` is the first tier (default: ``frequent_lengths`` of ``docs``).
    """
    own = keyed_text(docs, id_col, text_col)
    if table is None:
        table = frequent_lengths(docs, tokenizer_path, plain_pattern, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = PreTokens(tokenizer_path, plain_pattern)
        lengths = LengthCache(shared.value, split.length)
        for batch in batches:
            counts = []
            for text in batch.column("text").to_pylist():
                words = split(text)
                whole = words is None
                counts.append(split.count_whole(text) if whole else sum(map(lengths.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    sized = own.withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
