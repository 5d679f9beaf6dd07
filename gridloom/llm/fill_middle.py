"""Fill-in-middle: a text is cut at two places, and its parts are put in another order behind marks.

DuckDB runs inside the tasks. A text is matched left to right into blocks of code points, so a list holds one entry a block
rather than one a code point; the places of the cuts and the form come from a seeded hash of the document's id alone, so that
a row that is computed again on another executor gives the same output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import text_of
from gridloom.llm.duck import map_by_sql

#: What stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Code points that one match takes.
BLOCK = 64
BATCH_BYTES = 4 << 20


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _transform_sql(seed: int, percent: int, suffix_first: int, marks: tuple[str, str, str]) -> str:
    prefix, suffix, middle = map(_quoted, marks)
    held = " OR ".join(f"contains(text, {_quoted(m)})" for m in marks)
    number = lambda i: f"('0x' || substr(digest, {8 * i + 1}, 8))::BIGINT"
    cut = lambda a, b: f"substring(array_to_string(list_slice(blocks, {a} // {BLOCK} + 1, ({b} + {BLOCK - 1}) // {BLOCK}), ''), {a} % {BLOCK} + 1, {b} - {a})"
    return f"""
    WITH cut_up AS (
      SELECT doc_id, text, regexp_extract_all(text, '(?s).{{1,{BLOCK}}}') AS blocks, sha256({_quoted(f"{seed}:")} || coalesce(doc_id::VARCHAR, '')) AS digest FROM batch
    ), counted AS (
      SELECT *, coalesce({BLOCK} * (len(blocks) - 1) + length(blocks[len(blocks)]), 0)::BIGINT AS n, {number(0)} AS h1, {number(1)} AS h2,
        CASE WHEN text = '' OR {held} OR {number(2)} % 100 >= {percent} THEN 'plain' WHEN {number(3)} % 100 < {suffix_first} THEN 'spm' ELSE 'psm' END AS form FROM cut_up
    ), placed AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM counted
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
      CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN {prefix} || {cut("0", "a")} || {suffix} || {cut("b", "n")} || {middle} || {cut("a", "b")}
        ELSE {suffix} || {cut("b", "n")} || {prefix} || {cut("0", "a")} || {middle} || {cut("a", "b")} END AS output
    FROM placed
    """


def fill_in_middle(docs: DataFrame, seed: int = 1, percent: int = 90, suffix_first: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """One row a document: doc_id, n (code points), form, prefix_chars, middle_chars and the output itself.

    ``percent`` of the documents are transformed, and of these ``suffix_first`` in a hundred have the suffix first (spm, the others psm).
    A text that is empty or holds a mark is plain: its output is the text, its counts are null. Null text counts as empty. A document
    without an id is cut as the seed and the empty id say. Rows that share an id are cut at places drawn from the same numbers; repeated
    rows give repeated rows, an empty table an empty one; other columns are not looked at.
    """
    if any(a[0] in b[1:] for a in marks for b in marks) or any(a.startswith(b) for a in marks for b in marks if a is not b):
        raise ValueError("no mark may begin inside another, or with another")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    columns = {"doc_id": "long", "n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    return map_by_sql(rows, _transform_sql(seed, percent, suffix_first, marks), columns, most_bytes=BATCH_BYTES)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` made an output of, from the output and its form alone.

    A text with marks of its own is never cut, and no mark can begin inside another, so the first of each mark is the one that was put there.
    """
    prefix, suffix, middle = marks
    before = lambda text, mark: F.substring_index(text, mark, 1)
    after = lambda text, mark: F.substring_index(text, mark, -1)
    last = after(output, middle)
    psm = F.concat(after(before(output, suffix), prefix), last, before(after(output, suffix), middle))
    spm = F.concat(before(after(output, prefix), middle), last, after(before(output, prefix), suffix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
