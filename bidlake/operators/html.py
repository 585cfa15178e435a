"""HTML documents -> flat "DOM fact" tables, one Arrow pass per batch.

Spark cannot hold a recursive tree, so each document is walked once (stdlib
``html.parser``) and flattened into two tables.  Elements are numbered in
document order and keep the number of the last element inside them (nested
sets), strings are numbered too and every element keeps the range of its
strings.  So "inside" is a range test, the facts are linear in the page, and
all extraction logic afterwards is ordinary joins, aggregates and filters.

``nodes``   one row per element, plus a root row (node_id -1) per document:
            doc_id, node_id (pre-order), last_id (of the last element inside,
            or its own), parent_id, tag, child_pos (index among element
            siblings), tag_pos (index among same-tag element siblings),
            first_seq / end_seq (its strings: first_seq <= seq < end_seq),
            href, link_seq (ordinal of an ``a`` with ``href`` among those of
            its document), text (of an ``a`` with ``href``: its text nodes
            stripped, blanks dropped, joined by " "), tr_id / table_id
            (nearest enclosing ``tr`` / ``table``), cells (for a ``tr``: the
            string ranges of its first two ``td``, in order of their starts).
``strings`` one row per string node that is not blank: doc_id, seq, parent_id,
            kind (text / script / comment), text (stripped).

Tree rules: an end tag closes up to its nearest open match (unmatched end
tags are ignored); void elements never open; script, style and template
text and comments do not count as element text.  Markup that the parser
rejects is passed over to its ``>``, else to the next ``<``, and reading goes on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
VOID_TAGS = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
})
RAW_TEXT_TAGS = frozenset({"script", "style", "template"})
ROOT_ID = -1
ROOT_TAG = "[document]"
# ---------------------------------------------------------------------------

KEPT_CELLS = 2

_CELLS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
_FACTS = pa.schema([
    ("fact", pa.string()), ("doc_id", pa.string()), ("node_id", pa.int32()), ("last_id", pa.int32()), ("parent_id", pa.int32()), ("tag", pa.string()),
    ("child_pos", pa.int32()), ("tag_pos", pa.int32()), ("first_seq", pa.int32()), ("end_seq", pa.int32()), ("href", pa.string()), ("link_seq", pa.int32()),
    ("tr_id", pa.int32()), ("table_id", pa.int32()), ("cells", _CELLS), ("seq", pa.int32()), ("kind", pa.string()), ("text", pa.string())])
FACTS_SCHEMA = (
    "fact string, doc_id string, node_id int, last_id int, parent_id int, tag string, child_pos int, tag_pos int, first_seq int, end_seq int, "
    "href string, link_seq int, tr_id int, table_id int, cells array<struct<first: int, end: int>>, seq int, kind string, text string")
NODE_COLUMNS = ["doc_id", "node_id", "last_id", "parent_id", "tag", "child_pos", "tag_pos", "first_seq", "end_seq", "href", "link_seq", "text", "tr_id", "table_id", "cells"]
STRING_COLUMNS = ["doc_id", "seq", "parent_id", "kind", "text"]


class Flattener(HTMLParser):
    """Facts of one document as columns: place i of each list belongs to element i."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self.child_pos: list[int] = []
        self.tag_pos: list[int] = []
        self.first_seq: list[int] = []
        self.end_seq: list[int] = []
        self.href: list[str | None] = []
        self.link: list[int | None] = []
        self.tr: list[int | None] = []
        self.table: list[int | None] = []
        self.cells: list[list[int] | None] = []
        self.strings: list[tuple[int, str, str]] = []      # parent, kind, text
        self.skipped = 0                                   # markup the parser rejected
        self._stack: list[tuple[int, dict[str, int]]] = [(ROOT_ID, {})]  # open elements with their children per tag
        self._children = [0]
        self._open: Counter = Counter()
        self._rows: list[int] = []                         # open tr
        self._tables: list[int] = []
        self._hungry: list[int] = []                       # open tr with fewer than KEPT_CELLS cells
        self._pending: list[str] = []
        self._links = 0

    def _flush(self) -> None:
        """Adjacent data chunks form one string node (as in a parsed tree)."""
        if self._pending:
            text, self._pending = "".join(self._pending).strip(), []
            if text:
                top = self._stack[-1][0]
                self.strings.append((top, "script" if top >= 0 and self.tag[top] in RAW_TEXT_TAGS else "text", text))

    def _start(self, tag: str, attrs, void: bool) -> None:
        self._flush()
        parent, counts = self._stack[-1]
        number = len(self.tag)
        href = None
        for k, v in attrs:
            if k == "href":
                href = v if v is not None else ""
        self.tag.append(tag)
        self.parent.append(parent)
        self.last.append(number)
        self.child_pos.append(self._children[-1])
        place = counts.get(tag, 0)
        self.tag_pos.append(place)
        self._children[-1] += 1
        counts[tag] = place + 1
        self.first_seq.append(len(self.strings))
        self.end_seq.append(len(self.strings))
        self.href.append(href)
        self.link.append(None)
        self.tr.append(self._rows[-1] if self._rows else None)
        self.table.append(self._tables[-1] if self._tables else None)
        self.cells.append([] if tag == "tr" else None)
        if tag == "a" and href is not None:
            self.link[number] = self._links
            self._links += 1
        if tag == "td":  # a cell stands where it starts, before the cells nested in it
            for row in self._hungry:
                self.cells[row].append(number)
            self._hungry = [row for row in self._hungry if len(self.cells[row]) < KEPT_CELLS]
        if void:
            return
        self._stack.append((number, {}))
        self._children.append(0)
        self._open[tag] += 1
        if tag == "tr":
            self._rows.append(number)
            self._hungry.append(number)
        elif tag == "table":
            self._tables.append(number)

    def _end(self) -> str:
        """Closes the innermost open element."""
        number, _ = self._stack.pop()
        self._children.pop()
        tag = self.tag[number]
        self._open[tag] -= 1
        self.last[number], self.end_seq[number] = len(self.tag) - 1, len(self.strings)
        if tag == "tr":
            self._rows.pop()
            if self._hungry and self._hungry[-1] == number:
                self._hungry.pop()
        elif tag == "table":
            self._tables.pop()
        return tag

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, tag in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, True)

    def handle_endtag(self, tag):
        self._flush()
        if self._open[tag]:
            while self._end() != tag:
                pass

    def updatepos(self, i, j):
        """Lines and columns are not asked for."""
        return j

    def handle_data(self, data):
        self._pending.append(data)

    def handle_comment(self, data):
        self._flush()
        if data.strip():
            self.strings.append((self._stack[-1][0], "comment", data.strip()))

    def _rest_after(self, read, i: int) -> int:
        """Where reading goes on; a token that the parser rejects is passed over: to its ``>``, else to the next ``<``."""
        try:
            return read(i)
        except Exception:  # noqa: BLE001 - the parser's own checks raise several kinds
            self.skipped += 1
            closed, opened = (self.rawdata.find(c, i + 1) for c in "><")
            if closed >= 0 and (opened < 0 or closed < opened):
                return closed + 1
            return opened if opened >= 0 else len(self.rawdata)

    def parse_starttag(self, i):
        return self._rest_after(super().parse_starttag, i)

    def parse_endtag(self, i):
        return self._rest_after(super().parse_endtag, i)

    def parse_pi(self, i):
        return self._rest_after(super().parse_pi, i)

    def parse_html_declaration(self, i):
        return self._rest_after(super().parse_html_declaration, i)

    def finish(self) -> None:
        self._flush()
        while len(self._stack) > 1:
            self._end()

    def text_of(self, number: int, separator: str = " ") -> str:
        return separator.join(text for _, kind, text in self.strings[self.first_seq[number]:self.end_seq[number]] if kind == "text")


def flatten(html: str | None) -> Flattener:
    """One document -> its facts; a null document has a root and nothing else."""
    f = Flattener()
    if html:
        f.feed(html)
    f.close()
    f.finish()
    return f


_NODE_LISTS = [c for c in NODE_COLUMNS if c not in ("doc_id", "cells")]
_STRING_LISTS = [c for c in STRING_COLUMNS if c != "doc_id"]


class FactRows:
    """Facts of several documents as columns, until they are sent on as batches."""

    def __init__(self):
        self.size = 0
        self.documents: list[tuple[str, int, int]] = []   # doc_id, its nodes, its strings
        self.nodes: dict[str, list] = {c: [] for c in _NODE_LISTS}
        self.strings: dict[str, list] = {c: [] for c in _STRING_LISTS}
        self.cells: tuple[list, list, list] = ([0], [], [])  # ends of the rows' lists, first and end of each cell
        self.no_cells: list[bool] = []

    def add(self, doc_id: str, html: str | None) -> None:
        f = flatten(html)
        n, m = len(f.tag), len(f.strings)
        texts = [None if link is None else f.text_of(i) for i, link in enumerate(f.link)]
        own = {"node_id": range(n), "last_id": f.last, "parent_id": f.parent, "tag": f.tag, "child_pos": f.child_pos, "tag_pos": f.tag_pos, "first_seq": f.first_seq,
               "end_seq": f.end_seq, "href": f.href, "link_seq": f.link, "text": texts, "tr_id": f.tr, "table_id": f.table}
        root = {"node_id": ROOT_ID, "last_id": n - 1, "tag": ROOT_TAG, "child_pos": 0, "tag_pos": 0, "first_seq": 0, "end_seq": m}
        for name, values in self.nodes.items():
            values.extend(own[name])
            values.append(root.get(name))
        ends, firsts, lasts = self.cells
        for cells in f.cells:
            for c in cells or ():
                firsts.append(f.first_seq[c])
                lasts.append(f.end_seq[c])
            ends.append(len(firsts))
            self.no_cells.append(cells is None)
        ends.append(len(firsts))
        self.no_cells.append(True)
        if m:
            parents, kinds, texts_ = zip(*f.strings)
            for name, values in (("seq", range(m)), ("parent_id", parents), ("kind", kinds), ("text", texts_)):
                self.strings[name].extend(values)
        self.documents.append((doc_id, n + 1, m))
        self.size += 80 * (n + 1) + 40 * m + 3 * len(html or "")

    def batches(self) -> Iterator[pa.RecordBatch]:
        ids = pa.array([d for d, _, _ in self.documents], pa.string())
        ends, firsts, lasts = self.cells
        cells = pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], fields=list(_CELLS.value_type)),
            mask=pa.array(self.no_cells, pa.bool_()))
        for kind, place, lists, more in (("node", 1, self.nodes, {"cells": cells}), ("string", 2, self.strings, {})):
            many = np.array([d[place] for d in self.documents], dtype=np.int64)
            rows = int(many.sum())
            if rows:
                found = {"fact": pa.repeat(kind, rows), "doc_id": ids.take(pa.array(np.repeat(np.arange(len(many)), many))), **more}
                yield pa.RecordBatch.from_arrays(
                    [found[f.name] if f.name in found else pa.array(lists[f.name], f.type) if f.name in lists else pa.nulls(rows, f.type) for f in _FACTS], schema=_FACTS)


BATCH_BYTES = 8 << 20


def _facts_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of the documents, gathered into batches of bounded bytes."""
    part = FactRows()
    for batch in batches:
        for doc_id, html in zip(batch.column("doc_id"), batch.column("html")):
            part.add(doc_id.as_py(), html.as_py())
            if part.size > BATCH_BYTES:
                yield from part.batches()
                part = FactRows()
    yield from part.batches()


BUCKET_DOCUMENTS = 5000  # documents of a bucket, about


def _buckets(docs: DataFrame) -> int:
    """So many that a bucket holds a bounded number of documents, and that few documents are parsed side by side too."""
    rows = docs.count()
    return max(-(-rows // BUCKET_DOCUMENTS), min(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-rows // 50)), 1)


def dom_facts(docs: DataFrame, id_col: str = "doc_id", html_col: str = "html",
              materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(nodes, strings)`` from ONE parse of every document.

    Extraction plans read the facts many times; with ``materialize`` they are
    written once as Parquet into the session's shared checkpoint folder, the
    two kinds apart, so the parse never reruns, scans read only the columns
    they need, and a lost executor re-reads files instead of re-parsing.  The
    files are bucketed by document: joins, aggregates and windows of facts
    that have ``doc_id`` among their keys shuffle none of them again (the
    session is told that a part of a join's keys may deal its rows).  Both are
    joined by sort and merge: Spark knows but the size of the files, in which
    numbers and tags take up to a fortieth of their room in memory, and would
    send facts of hundreds of MB through the driver to broadcast them.
    """
    from bidlake.session import stored_buckets

    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(html_col).cast("string").alias("html"))
    if materialize:
        docs.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        buckets = _buckets(docs)
        facts = stored_buckets(src.repartition(buckets, "doc_id").mapInArrow(_facts_batches, FACTS_SCHEMA), "doc_id", buckets, partition_by="fact")
    else:
        facts = src.mapInArrow(_facts_batches, FACTS_SCHEMA)
    nodes = facts.where(F.col("fact") == "node").select(*NODE_COLUMNS)
    strings = facts.where(F.col("fact") == "string").select(*STRING_COLUMNS)
    return nodes.hint("merge"), strings.hint("merge")


def anchors(nodes: DataFrame) -> DataFrame:
    """Elements ``a`` carrying an ``href`` attribute, in document order (node_id)."""
    return nodes.where(F.col("link_seq").isNotNull())


def texts_of(strings: DataFrame, ranges: DataFrame, keys: list[str], separator: str = " ", out_col: str = "text") -> DataFrame:
    """The keys and the text of string ranges (doc_id, first_seq, end_seq and the keys).

    A range names its strings one by one, so the join is by (doc_id, seq) and
    makes one row per string wanted.  Ranges without text give no row.
    """
    wanted = ranges.where("first_seq < end_seq").select("doc_id", *keys, F.explode(F.sequence("first_seq", F.col("end_seq") - 1)).alias("seq"))
    found = wanted.join(strings.where("kind = 'text'").select("doc_id", "seq", "text"), ["doc_id", "seq"])
    pieces = F.array_sort(F.collect_list(F.struct("seq", "text")))  # the strings of one element
    return found.groupBy("doc_id", *keys).agg(F.concat_ws(separator, F.transform(pieces, lambda p: p["text"])).alias(out_col))
