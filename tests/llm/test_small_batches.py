"""Batches are worked on in slices: the same rows, and memory that follows the slice, not the batch."""

import tracemalloc

import pyarrow as pa
from listingflow.llm import jaccard
from listingflow.llm.common import ROWS, small


def batch(n, words=200):
    numbers = pa.array(range(n), pa.int64())
    text = pa.array([" ".join(f"w{i}x{k}" for k in range(words)) for i in range(n)])
    return pa.RecordBatch.from_arrays([numbers, numbers, numbers, numbers, text], names=["row", "id", "k1", "k2", "text"])


def test_slices_are_the_whole_batch():
    whole = batch(2 * ROWS + 7, 3)
    parts = list(small([whole, batch(0), batch(1, 3)]))
    assert [p.num_rows for p in parts] == [ROWS, ROWS, 7, 1]
    assert pa.Table.from_batches(parts[:3]).combine_chunks().equals(pa.Table.from_batches([whole]))


def peak(n):
    one = batch(n)
    tracemalloc.start()
    rows = sum(out.num_rows for out in jaccard._scan([one], 4, 85))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n
    return most


def test_scan_holds_a_slice():
    assert peak(8 * ROWS) < 2 * peak(ROWS)
