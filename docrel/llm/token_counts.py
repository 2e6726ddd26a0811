"""Edit-aware token counts.

Each document keeps a segment tree over its pre-tokens: a leaf covers a run of
``LEAF_WORDS`` words, or of about ``LEAF_CHARS`` code points where those are longer,
and starts where a pre-token does; an inner node holds the sum of its children.
The tokenizer joins no pre-tokens, so the counts of leaves add up to the document's, and an edit changes only the leaves that it touches and, where it may
join pre-tokens over a leaf's end, the leaves beside them.  Those are encoded anew as
one region and the sums above them are brought up to date; the rest of the text
is not encoded again.

Trees are a table of their own: (id, tie, starts, tree).  ``starts`` are the code
point offsets of the leaves, ``tree`` the nodes: node 1 is the root, the children
of i are 2i and 2i + 1, leaf k is node ``len(starts) + k``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import stored, text_of
from docrel.llm.tokens import WordTokens, default_path

LEAF_WORDS = 64
LEAF_CHARS = 1024

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# Letters of common scripts, and signs that no contraction or special token holds.
_LETTERS = ("A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0400-\u0481"
            "\u048a-\u052f\u05d0-\u05ea\u0620-\u064a\u0e01-\u0e30\u3041-\u3096\u30a1-\u30fa"
            "\u4e00-\u9fff\uac00-\ud7a3")
_SIGNS = r'!"#$%&()*+,\-./:;=?@\[\\\]^_`{}~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f'
#: Places where a text may be cut without any change of its pre-tokens, whatever lies
#: beyond the two characters there: after a space, beside a digit, and between a
#: letter and a sign after it.
_CUT = re.compile(r"(?<=[\x20\x09-\x0D])|(?<=[0-9])(?!$)|(?<=[^'])(?=[0-9])"
                  f"|(?<=[{_LETTERS}])(?=[{_SIGNS}])")


def leaf_starts(text: str, leaf_words: int = LEAF_WORDS, leaf_chars: int = LEAF_CHARS) -> list[int]:
    """Offsets at which leaves start: 0, every ``leaf_words``-th word's, and the first
    place to cut after each ``leaf_chars`` code points of a longer leaf."""
    at = [m.start() for i, m in enumerate(_WORDS.finditer(text)) if i % leaf_words == 0]
    out: list[int] = []
    for a, b in zip([0, *at[1:]], [*at[1:], len(text)]):
        out.append(a)
        while b - out[-1] > leaf_chars and (cut := _CUT.search(text, out[-1] + leaf_chars, b)):
            if cut.start() >= b:
                break
            out.append(cut.start())
    return out


def build(counts: list[int]) -> np.ndarray:
    """The nodes of a segment tree over leaf counts (node 0 is not used)."""
    n = len(counts)
    tree = np.zeros(2 * n, np.int64)
    tree[n:] = counts
    for i in range(n - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def total(tree: np.ndarray) -> int:
    return int(tree[1])


def update(tree: np.ndarray, leaves: dict[int, int]) -> int:
    """Set leaf counts and refresh the sums above them; how many nodes were set."""
    n = len(tree) // 2
    for k, v in leaves.items():
        tree[n + k] = v
    dirty, touched = {(n + k) // 2 for k in leaves} - {0}, len(leaves)
    while dirty:  # children before parents
        i = max(dirty)
        dirty.remove(i)
        tree[i] = tree[2 * i] + tree[2 * i + 1]
        touched += 1
        if i > 1:
            dirty.add(i // 2)
    return touched


def edit(text: str, starts: np.ndarray, tree: np.ndarray, at: int, length: int, new: str,
         count) -> tuple[str, int, int]:
    """Replace ``length`` code points at ``at`` and bring ``starts`` and ``tree`` up to date.

    Gives the new text, the code points that were encoded and the nodes that were set.
    """
    at = max(0, min(at, len(text)))
    length = max(0, min(length, len(text) - at))
    # the characters there, unlike the text around them, are copied in no time
    near = lambda i: text[max(0, i - 1):min(i, at)] + (new + text[at + length:at + length + 1] if i == at
                                                       else text[i:i + 1])[:1]
    # from the leaf's start, if the text may still be cut there
    first = int(np.searchsorted(starts, at, "right")) - 1
    while first and not _CUT.match(near(int(starts[first])), 1):
        first -= 1
    # to the next leaf's start, if the characters beside it are left
    last = int(np.searchsorted(starts, at + length, "right")) - 1
    while last + 1 < len(starts) and not (starts[last + 1] > at + length
                                          and _CUT.match(text[starts[last + 1] - 1:starts[last + 1] + 1], 1)):
        last += 1
    begin = int(starts[first])
    end = int(starts[last + 1]) if last + 1 < len(starts) else len(text)
    region = text[begin:at] + new + text[at + length:end]
    # the region's pre-tokens keep to its leaves as evenly as they allow
    own = leaf_starts(region)
    per = -(-len(own) // (last - first + 1))
    cuts = own[::per] + [len(region)] * (last - first + 1 - len(own[::per]))
    ends = [*cuts[1:], len(region)]
    sums = {first + i: count(region[a:b]) if b > a else 0 for i, (a, b) in enumerate(zip(cuts, ends))}
    grown = len(new) - length
    starts[first:last + 1] = [begin + c for c in cuts]
    starts[last + 1:] += grown
    return text[:at] + new + text[at + length:], len(region), update(tree, sums)


def trees(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None,
          leaf_words: int = LEAF_WORDS) -> DataFrame:
    """(id, tie, starts, tree) of every row; ``tie`` is a hash of its text.

    A null or empty text has one leaf of no tokens.
    """
    path = path or default_path()
    src = df.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("tie"),
                    text_of(text_col).alias("body"))
    id_ddl = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(path)
        for b in batches:
            starts, nodes = [], []
            for x in b.column(2):
                text = x.as_py()
                at = leaf_starts(text, leaf_words)
                starts.append(at)
                nodes.append(build([words.count(text[i:j]) for i, j in zip(at, [*at[1:], len(text)])]).tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(nodes, pa.list_(pa.int64()))], names=["id", "tie", "starts", "tree"])

    return src.mapInArrow(run, f"id {id_ddl}, tie long, starts array<int>, tree array<long>")


def apply_edits(df: DataFrame, kept: DataFrame, edits: F.Column, id_col: str = "doc_id",
                text_col: str = "text", *, path: str | None = None) -> DataFrame:
    """Counts after edits: id, tie, n_tokens, edited_tokens, encoded_chars, nodes_set,
    edited_chars, edited_sha256, and the new starts and tree.

    ``kept`` holds the documents' trees; ``edits`` is a column over ``df`` of
    array<struct<at:int,length:int,new:string>>, applied in order, each to the
    text that the one before left.  A null or empty array edits nothing.  Offsets
    beyond the text are taken as its end.
    """
    path = path or default_path()
    src = df.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("tie"),
                    text_of(text_col).alias("body"), edits.alias("edits"))
    one = kept.dropDuplicates(["id", "tie"])  # repeated rows have equal trees
    rows = src.alias("s").join(one.alias("t"), F.col("s.id").eqNullSafe(F.col("t.id"))
                               & (F.col("s.tie") == F.col("t.tie"))) \
              .select("s.id", "s.tie", "body", "edits", "starts", "tree")
    id_ddl = src.schema["id"].dataType.simpleString()
    schema = (f"id {id_ddl}, tie long, n_tokens long, edited_tokens long, encoded_chars long, "
              "nodes_set long, edited_chars long, edited_sha256 string, starts array<int>, tree array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        words = WordTokens(path)
        for b in batches:
            out = [[] for _ in range(8)]
            for body, todo, starts, tree in zip(*(b.column(i) for i in range(2, 6))):
                text = body.as_py()
                starts, tree = np.array(starts.as_py(), np.int32), np.array(tree.as_py(), np.int64)
                before, encoded, nodes = total(tree), 0, 0
                for e in todo.as_py() or []:
                    text, chars, touched = edit(text, starts, tree, e["at"], e["length"], e["new"] or "",
                                                words.count)
                    encoded += chars
                    nodes += touched
                for x, v in zip(out, (before, total(tree), encoded, nodes, len(text),
                                      hashlib.sha256(text.encode()).hexdigest(), starts.tolist(), tree.tolist())):
                    x.append(v)
            kinds = [*[pa.int64()] * 5, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(x, k) for x, k in zip(out, kinds))],
                names=["id", "tie", "n_tokens", "edited_tokens", "encoded_chars", "nodes_set",
                       "edited_chars", "edited_sha256", "starts", "tree"])

    return rows.mapInArrow(run, schema)


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every document before and after two edits that its text gives: 40
    code points after its first third become its first 20, and ten near its end go."""
    kept = stored(trees(df, id_col, text_col), "trees")
    body = text_of(text_col)
    n = F.length(body)
    edits = F.array(
        F.struct(F.floor(n / 3).cast("int").alias("at"), F.lit(40).alias("length"),
                 F.substring(body, 1, 20).alias("new")),
        F.struct(F.greatest(n - 30, F.lit(0)).cast("int").alias("at"), F.lit(10).alias("length"),
                 F.lit("").alias("new")))
    out = apply_edits(df, kept, edits, id_col, text_col)
    return out.select(F.col("id").alias(id_col), "n_tokens", "edited_tokens", "encoded_chars", "nodes_set",
                      "edited_chars", "edited_sha256")
