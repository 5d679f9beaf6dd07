"""What a Python worker holds of a batch of pages is bounded by a part of it, not by the batch."""

import html
import tracemalloc

import pyarrow as pa

from gridloom.functions import text as TX

LINKS = "".join(f'<a href="/pools/pool-{i}">Pool {i} &amp; more</a>' for i in range(100))


def peak(f, *columns):
    """(result, most bytes of Python values at once)."""
    tracemalloc.start()
    found = f(*columns)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found, most


def test_links_of_a_large_batch_are_made_in_parts():
    pages = [f"{i}{LINKS}" if i % 7 else None for i in range(1500)]
    base = [f"https://h{i}.example/" for i in range(1500)]
    found, most = peak(TX.extract_links.func, pa.array(pages), pa.array(base))
    assert len(found) == 1500 and found[7].as_py() == [] and found[-1].as_py()[99] == {"pos": 99, "url": "https://h1499.example/pools/pool-99", "text": "Pool 99 & more"}
    assert sum(len(x) for x in found.to_pylist()) == 100 * sum(p is not None for p in pages)
    assert most < 20e6  # 150,000 links as Python values take over 60 MB


def test_texts_of_a_large_batch_are_unescaped_in_parts():
    texts = [LINKS * 3 if i % 5 else None for i in range(1500)] + ["&lt;" * 10**6, "a", ""]
    found, most = peak(TX._unescaped.func, pa.array(texts))
    assert found.to_pylist() == [None if t is None else html.unescape(t) for t in texts]
    assert most < 30e6  # one text of 4 MB stands alone


def test_parts_keep_order_and_empty_batches():
    sizes = []

    def upper(part):
        sizes.append(sum(map(len, part)))
        return [t.upper() for t in part]

    texts = ["a"] * 5000 + ["b" * 300_000] * 20 + ["c"] * 5
    assert TX.in_parts(upper, pa.string(), pa.array(texts)).to_pylist() == [t.upper() for t in texts]
    assert max(sizes) <= 2 * TX.PART_BYTES and TX.in_parts(upper, pa.string(), pa.array([], pa.string())).to_pylist() == []
