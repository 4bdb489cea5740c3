"""How far the words of sources lie from each other and from their language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.tables import broadcast_if_small, parts, utf8
from gapwise.llm.words import in_slices
from gapwise.operators.hot import spread_join
from gapwise.scratch import materialize

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000  # of the probabilities, which are integers
# A block ends when its postings take about this much memory.
BLOCK_BYTES = 96 << 20
_POSTING = 160  # bytes that a posting takes beside its term
_RUN_ROWS = 20_000  # postings handed on at once
_PAIRS = 1 << 20  # pairs of postings that a task computes at once
_DENSE = 1 << 14  # pairs of groups that are summed in a table of all of them
_HELD = 200_000  # pair sums that a task holds before it hands them on

# A term is a run of letters A-Z and of characters beyond ASCII; only A-Z lose their
# case.  In UTF-8 such characters have only bytes from 0x80 on, so bytes can be looked up one by one.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def text_terms(text: bytes) -> list[bytes]:
    """The terms of a text in their order."""
    return text.translate(_TERM_BYTES).split()


class _Block:
    """Postings in memory: occurrences, and documents that have the term, by language and source."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.bytes = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        n, docs = self.counts.setdefault((lang, source), (Counter(), Counter()))
        terms = text_terms(text)
        known = len(n)
        n.update(terms)
        docs.update(single := set(terms))
        fresh = len(n) - known
        if fresh:
            # New terms are at least as long as the mean of the document's.
            self.bytes += fresh * _POSTING + sum(map(len, single)) * fresh // len(single)

    def runs(self) -> Iterator[pa.RecordBatch]:
        """Per group the postings sorted by term, after one with an empty term that tells of the
        group itself."""
        for (lang, source), (n, docs) in sorted(self.counts.items()):
            terms = [b"", *sorted(n)]
            for begin in range(0, len(terms), _RUN_ROWS):
                some = terms[begin : begin + _RUN_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), len(some)),
                        pa.array(some, pa.binary()),
                        pa.repeat(pa.scalar(source, pa.string()), len(some)),
                        pa.array([n[t] for t in some], pa.int64()),
                        pa.array([docs[t] for t in some], pa.int64()),
                    ],
                    names=["lang", "term", "source", "n", "docs"],
                )
        self.counts.clear()


def _runs(block_bytes: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for rows in in_slices(batch, 50):
                for lang, source, text in zip(*rows):
                    block.add(lang, source, text)
                    if block.bytes >= block_bytes:
                        yield from block.runs()
                        block = _Block()
        yield from block.runs()

    return of


def postings(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Kept terms of each language: (``lang``, ``term``, ``source``, ``n``) with ``total``, the
    term's occurrences in the language, and ``head``, true for one source of each term.

    A term is kept if ``min_docs`` documents of its language have it.  Every group (lang, source)
    also has a row with an empty term, so that groups without terms are there.  Null texts,
    languages and sources count as ''.

    The documents are read once.  A task counts them in memory block by block; a full block is
    handed on as runs sorted by term, one per group.  The runs of a hash shard of (language, term) are merged by
    the sort of its task, which spills.  A frequent term comes as one row per block and source, and
    meets in one shard as such.
    """
    given = docs.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))],
        utf8(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    runs = given.mapInArrow(_runs(block_bytes), "lang string, term binary, source string, n long, docs long")
    sharded = runs.repartition(parts(docs), "lang", "term")
    merged = sharded.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term").orderBy("source")
    whole = of_term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = merged.withColumns(
        {
            "total": F.sum("n").over(whole),
            "_docs": F.sum("docs").over(whole),
            "head": F.row_number().over(of_term) == 1,
        }
    ).where((F.col("_docs") >= min_docs) | (F.length("term") == 0))
    return materialize(kept.select("lang", "term", "source", "n", "total", "head"), "postings")


def _groups(found: DataFrame) -> DataFrame:
    """Every group with its occurrences ``size``, and its language's terms ``kinds`` and ``whole``,
    the language's occurrences."""
    is_term = F.length("term") > 0
    groups = found.groupBy("lang", "source").agg(
        F.sum("n").alias("size"), F.count_if(F.col("head") & is_term).alias("_kinds")
    )
    of_lang = groups.groupBy(F.col("lang").alias("_lang")).agg(
        F.sum("size").alias("whole"), F.sum("_kinds").alias("kinds")
    )
    table = groups.join(broadcast_if_small(of_lang, 64), F.col("lang") == F.col("_lang"))
    return materialize(table.select("lang", "source", "size", "whole", "kinds"), "groups")


def _probability(n: Column, size: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (size + kinds)), exact for counts of any size; null without terms."""
    wide = [c.cast("decimal(20,0)") for c in (n + 1, size + kinds)]
    share = F.floor(F.call_function("div", wide[0] * F.lit(SCALE).cast("decimal(10,0)"), wide[1]))
    return F.when(kinds > 0, share.cast("long") + 1)


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two sources of one term add to their sums beyond what each adds alone.

    Rows (lang, term, source, p, p0) come sorted by term; all rows of a term are in one task.
    """
    sums: dict[tuple[str, str, str], int] = {}
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest else table
        ends = _term_ends(table)
        if len(ends):
            _add_meetings(table.slice(0, ends[-1]), ends, sums)
        rest = table.slice(ends[-1] if len(ends) else 0)
        if len(sums) >= _HELD:
            yield _pair_sums(sums)
            sums = {}
    if rest and rest.num_rows:
        _add_meetings(rest, np.array([rest.num_rows]), sums)
    yield _pair_sums(sums)


def _term_ends(table: pa.Table) -> np.ndarray:
    """Where terms end that another term follows."""
    differs = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in ("lang", "term"):
        column = table.column(name).combine_chunks()
        differs |= np.asarray(pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False), bool)
    return np.flatnonzero(differs) + 1


def _pair_sums(sums: dict[tuple[str, str, str], int]) -> pa.RecordBatch:
    keys = list(zip(*sums)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [*(pa.array(k, pa.string()) for k in keys), pa.array(sums.values(), pa.int64())],
        names=["lang", "source", "item", "value"],
    )


def _add_meetings(table: pa.Table, ends: np.ndarray, sums: dict[tuple[str, str, str], int]) -> None:
    begins = np.concatenate([[0], ends[:-1]])
    p, p0 = (table.column(c).to_numpy() for c in ("p", "p0"))
    langs, sources = (table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    width = len(sources.dictionary)
    groups, code = np.unique(
        langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy(), return_inverse=True
    )
    found: dict[int, int] = {}
    lengths = ends - begins
    for length in np.unique(lengths[lengths > 1]):
        at = begins[lengths == length]
        step = max(1, _PAIRS // int(length))
        for some in np.array_split(at, -(-len(at) // step)):
            here = some[:, None] + np.arange(length)
            for i in range(length):
                _one_against_all(here, i, p, p0, code, len(groups), found)
    lang, source = langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
    for key, value in found.items():
        a, b = (int(groups[c]) for c in divmod(key, len(groups)))
        place = lang[a // width], source[a % width], source[b % width]
        sums[place] = sums.get(place, 0) + value


def _one_against_all(
    here: np.ndarray, i: int, p: np.ndarray, p0: np.ndarray, code: np.ndarray, n: int, found: dict[int, int]
) -> None:
    """The ``i``-th posting of every term against the term's other postings."""
    own, others = here[:, [i]], np.delete(here, i, axis=1)
    q, q0 = p[others], p0[others]
    both = _over(p[own], q) - _over(p[own], q0) - _over(p0[own], q) + _over(p0[own], q0)
    keys = (code[own] * n + code[others]).ravel()
    if n * n <= _DENSE:
        total = np.zeros(n * n, np.int64)
        np.add.at(total, keys, both.ravel())
        keys = np.flatnonzero(total)
        total = total[keys]
    else:
        keys, place = np.unique(keys, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, both.ravel())
    for key, value in zip(keys.tolist(), total.tolist()):
        found[key] = found.get(key, 0) + value


def _over(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _named(lang: str = "lang", source: str = "source") -> Column:
    return F.octet_length(lang) + F.octet_length(source) + 64


def _scored(found: DataFrame, groups: DataFrame) -> DataFrame:
    """Terms of each source with ``p``, ``p0`` (what a term has there that does not occur) and
    ``q``, the language's."""
    table = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "size", "whole", "kinds")
    same = (F.col("lang") == F.col("_lang")) & (F.col("source") == F.col("_source"))
    small = broadcast_if_small(table, _named("_lang", "_source"))
    joined = found.where((F.length("term") > 0) & (F.col("n") > 0))
    joined = joined.join(small, same) if small is not table else spread_join(joined, table, same, "inner")
    kinds = F.col("kinds")
    return joined.select(
        "lang",
        "term",
        "source",
        _probability(F.col("n"), F.col("size"), kinds).alias("p"),
        _probability(F.lit(0), F.col("size"), kinds).alias("p0"),
        _probability(F.col("total"), F.col("whole"), kinds).alias("q"),
    )


def _pair_values(scored: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language.

    All kept terms as if none occurred in either source, plus what changes for the terms that one
    source has, plus what changes for those that both have.  The second depends on the term's count
    alone, so it is computed once per source and count; only the last looks at single terms, and
    hands on sums per pair of sources.
    """
    p0 = _probability(F.lit(0), F.col("size"), F.col("kinds"))
    here = groups.select("lang", "source", "kinds", p0.alias("p0"))
    there = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("item"), p0.alias("q0"))
    small = broadcast_if_small(there, _named("_lang", "item"))
    other = (F.col("lang") == F.col("_lang")) & (F.col("source") != F.col("item"))

    def with_others(df: DataFrame) -> DataFrame:
        return df.join(small, other) if small is not there else spread_join(df, there, other, "inner")

    def wide(value: Column) -> Column:
        return value.cast("decimal(38,0)").alias("value")

    none = F.col("kinds").cast("decimal(20,0)") * _excess(F.col("p0"), F.col("q0"))
    base = with_others(here).select("lang", "source", "item", wide(F.coalesce(none, F.lit(0))))

    counts = scored.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("_terms"))
    p, p0, q0, terms = F.col("p"), F.col("p0"), F.col("q0"), F.col("_terms").cast("decimal(20,0)")
    as_source = F.struct(F.col("source"), F.col("item"), wide(terms * (_excess(p, q0) - _excess(p0, q0))))
    as_item = F.struct(
        F.col("item").alias("source"), F.col("source").alias("item"), wide(terms * (_excess(q0, p) - _excess(q0, p0)))
    )
    alone = with_others(counts).select("lang", F.explode(F.array(as_source, as_item)).alias("_v")).select("lang", "_v.*")

    by_term = scored.select("lang", "term", "source", "p", "p0")
    by_term = by_term.repartition(parts(scored), "lang", "term").sortWithinPartitions("lang", "term")
    both = by_term.mapInArrow(_meetings, "lang string, source string, item string, value long")
    both = both.select("lang", "source", "item", wide(F.col("value")))
    total = base.unionByName(alone).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return total.withColumn("value", F.col("value").cast("long"))


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per language and source: how far its word frequencies are from every other source's (part
    ``pair``, all ranks) and the terms most above the language's (part ``term``, ``top_terms``).

    A term that occurs ``n`` times in a group of ``size`` occurrences has the probability
    1 + floor(10^9 (n + 1) / (size + V)), V being the language's kept terms (see ``postings``); a
    term of probability p against q counts floor((p - q)^2 / q).  ``pair`` sums that over all kept
    terms, 0 if there are none; ``term`` lists the source's own terms with p > q.  Ranks go by
    value, then by item in the order of its UTF-8 bytes.  All arithmetic is exact.

    Null texts, languages and sources count as ''; sources without terms are compared too; a
    language with one source has no pairs.  Repeated rows are documents like any others, and other
    columns are ignored.  No documents, no rows.
    """
    found = postings(docs, text, lang, source, min_docs, block_bytes)
    groups = _groups(found)
    scored = materialize(_scored(found, groups), "scored")
    above = scored.where("p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"), _excess(F.col("p"), F.col("q")).alias("value")
    )
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))

    def as_part(part: str, values: DataFrame) -> DataFrame:
        return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))

    terms = as_part("term", above).where(F.col("rank") <= top_terms)
    return as_part("pair", _pair_values(scored, groups)).unionByName(terms)
