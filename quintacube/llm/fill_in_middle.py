"""Fill-in-the-middle: texts cut at two lines and put together in another order.

A text's lines form an indexable skip list. Its lowest lane has a link for every line; each lane above
links every `FAN`-th place of the one below. A link carries two widths: the lines it passes and their
code points. Going down from the highest lane and adding up widths finds the code point at which the
k-th line begins, for any k, after at most `FAN` links a lane. The lane heights follow from the place,
so the list needs no random numbers and no rebalancing; lines are only ever put at its end.

Cuts and form come from a keyed hash of the id. A text that holds one of the marks stays as it is, so
marks in an output stand where they were put, and `restore` gives back the exact text.

Null and empty texts are empty and plain. A null id is hashed like an empty one. Repeated rows get
equal results. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 7, 100, 50
FAN = 8
#: Characters in one batch that a task hands on.
BATCH_CHARS = 1 << 20


class SkipList:
    """Widths of units in order, with lanes that find the offset of any unit."""

    def __init__(self, widths: Iterator[int] | list[int] = ()):
        #: Per lane the code points of each link; a link of lane k passes FAN ** k units, if there are so many.
        self.lanes: list[list[int]] = [[]]
        for width in widths:
            self.append(width)

    def __len__(self) -> int:
        return len(self.lanes[0])

    def append(self, width: int) -> None:
        """Put a unit at the end; links are drawn above it where its place is a multiple of the lane's step."""
        lane, place = 0, len(self.lanes[0]) + 1
        self.lanes[0].append(width)
        while place % FAN == 0:
            place //= FAN
            if lane + 1 == len(self.lanes):
                self.lanes.append([])
            self.lanes[lane + 1].append(sum(self.lanes[lane][-FAN:]))
            lane += 1

    def offset(self, rank: int) -> int:
        """Code points before unit `rank`, or before the end if there are `rank` units."""
        if not 0 <= rank <= len(self):
            raise IndexError(rank)
        passed, chars = 0, 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            step, links = FAN**lane, self.lanes[lane]
            at = passed // step
            while passed + step <= rank and at < len(links):
                chars += links[at]
                passed += step
                at += 1
        return chars


def line_widths(text: str) -> list[int]:
    """Code points of each line, its newline included."""
    parts = text.split("\n")
    widths = [len(p) + 1 for p in parts[:-1]]
    return widths + [len(parts[-1])] if parts[-1] else widths


def choices(doc_id: int | None, seed: int = SEED) -> tuple[int, ...]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))


def transform(doc_id: int | None, text: str, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> tuple:
    """(lines, form, prefix code points, middle code points, output) of a text."""
    lines = SkipList(line_widths(text))
    n = len(lines)
    h1, h2, h3, h4 = choices(doc_id, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, z = lines.offset(one), lines.offset(two)
    prefix, middle, suffix = text[:a], text[a:z], text[z:]
    if h4 % 100 < spm:
        return n, "spm", a, z - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, z - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore(output: str, form: str) -> str:
    """The text that an output and its form came from."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    if not output.startswith(first):
        raise ValueError(f"not of form {form}")
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


_ROW = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_FIELDS = [
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
]


def _transform(seed: int, rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], [n for n, _ in _FIELDS]
            )

        for batch in batches:
            held, size = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_id = doc_id.as_py()
                held.append((doc_id, *transform(doc_id, text.as_py() or "", seed, rate, spm)))
                size += len(held[-1][-1])
                if size >= BATCH_CHARS:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)

    return run


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM
) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and output of every row.

    `rate` of 100 texts are transformed, `spm` of 100 of those with the suffix first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_transform(seed, rate, spm), _ROW)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        outputs, forms = batch.column(names.index("output")), batch.column(names.index("form"))
        held, size, begin = [], 0, 0
        for k, (output, form) in enumerate(zip(outputs, forms, strict=True)):
            held.append(restore(output.as_py(), form.as_py()))
            size += len(held[-1])
            if size >= BATCH_CHARS or k + 1 == len(batch):
                part = batch.slice(begin, k + 1 - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.string())], [*names, "restored"])
                held, size, begin = [], 0, k + 1


def restored(transformed: DataFrame) -> DataFrame:
    """Rows of `fill_in_middle` with the text rebuilt from output and form."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in transformed.schema.fields)
    return transformed.mapInArrow(_restore, f"{columns}, restored string")


def oracle_sql(seed: int = SEED, rate: int = RATE, spm: int = SPM) -> str:
    """The digests of the query in DuckDB SQL."""
    group = "('0x' || substr(sha256('{seed}:' || COALESCE(doc_id::VARCHAR, '')), {at}, 8))::UBIGINT AS h{k}"
    hashes = ", ".join(group.format(seed=seed, at=8 * k + 1, k=k + 1) for k in range(4))
    marks = " OR ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
    WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
                      {hashes} FROM documents),
    f AS (SELECT *, len(u) AS n, CASE WHEN t = '' OR {marks} OR h3 % 100 >= {rate} THEN 'plain'
                                      WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form,
                 least(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS a,
                 greatest(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS z FROM d),
    p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:z], '') AS middle,
                 array_to_string(u[z + 1:], '') AS suffix FROM f)
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t
                            WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                            ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p"""
