"""Helpers shared by the training-data operators: tables, scratch tables, files, words.

Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR
(``[^\\x20\\x09-\\x0D]+``), which is what ``bytes.split()`` yields.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from cardmart.session import checkpoint_root

#: A word as a regular expression that Java, DuckDB (RE2) and Python read alike.
WORD = r"[^\x20\x09-\x0D]+"
MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """A folder of its own below the shared checkpoint folder, for written tables and files.

    ``cut`` cuts the lineage of a frame by writing it there.  Folders go when
    the driver's Python ends; ``drop`` removes one table before that.
    """

    _made: list[tuple[SparkSession, str]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        if not Scratch._made:
            atexit.register(Scratch._clean)
        Scratch._made.append((spark, self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        _delete(self.spark, self.path(name))

    @staticmethod
    def _clean() -> None:
        for spark, root in Scratch._made:
            try:
                _delete(spark, root)
            except Exception:  # noqa: BLE001 -- the session may have ended already
                return


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def plain(docs: DataFrame, operator, keep: tuple[str, ...] = ("doc_id", "text", "lang", "source", "n_chars")) -> DataFrame:
    """``operator`` over ``docs``, in which columns not in ``keep`` have names that clash with nothing meanwhile.

    The operator returns the columns of its input, in their order, and may add some.
    """
    names = docs.columns
    out = operator(docs.toDF(*[c if c in keep else f"extra_{k}" for k, c in enumerate(names)]))
    return out.toDF(*names, *out.columns[len(names):])


# ---------------------------------------------------------------- files in the shared folder

def _filesystem(uri: str):
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        if urlparse(uri).scheme == "file":
            return fs.LocalFileSystem(), urlparse(uri).path
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_file(uri: str, data: bytes) -> None:
    """Write a file whole: under a name of this attempt, then renamed, so that a retried task replaces it."""
    system, path = _filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    attempt = f"{os.path.dirname(path)}/.{os.path.basename(path)}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt, compression=None) as out:
        out.write(data)
    system.move(attempt, path)


def mapped(uri: str, dtype) -> np.ndarray:
    """A file of numbers as a read-only memory map.

    A folder that is mounted (``file:``) is mapped in place, so workers of one
    machine share its pages.  From any other store the file is copied once per
    worker into its temporary folder and mapped there.
    """
    system, path = _filesystem(uri)
    if system.type_name != "local":
        local = os.path.join(tempfile.gettempdir(), uuid.uuid5(uuid.NAMESPACE_URL, uri).hex)
        if not os.path.exists(local):
            part = f"{local}.{uuid.uuid4().hex}"
            with system.open_input_stream(path) as src, open(part, "wb") as out:
                while chunk := src.read(1 << 24):
                    out.write(chunk)
            os.replace(part, local)
        path = local
    if os.path.getsize(path) == 0:
        return np.empty(0, dtype)
    return np.memmap(path, dtype=dtype, mode="r")


# ---------------------------------------------------------------- hashed words

class WordHash(dict):
    """64-bit hash of a word (xxh3), remembered for up to ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case (other letters unchanged)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(text: str | None, memo: WordHash) -> np.ndarray:
    words = lower_words(text)
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of one text.

    Fewer words than ``size``: the whole sequence is one shingle.  No words: empty.
    """
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    h = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        h = mixed((h + words[i:n - width + 1 + i]) * MIX)
    return np.unique(h)
