"""What a worker holds at a time."""

from __future__ import annotations

import tracemalloc

import numpy as np

from parcelledger.llm import common, jaccard_join, runs


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_words_take_the_place_of_what_the_worker_held():
    """The network and its memo stayed through every later stage, beside the words of the shingles."""
    common.held(("network", 0), dict)
    jaccard_join.shingles("one two three four five six")
    assert list(common._held) == [("shingle words",)]


def test_keys_of_a_task_make_no_wide_matrix():
    """A matrix of 200 rows and 60,000 columns is 48 MB; it grew with the number of buckets its rows fall into."""
    lists = [[*range(300 * i, 300 * i + 300), 10**6 + i // 2] for i in range(200)]
    found = runs.shares_smaller(lists, 10**7)
    pair = np.arange(200) // 2
    assert (found == (pair[:, None] == pair[None, :])).all()
    assert (runs.shares_smaller(lists, 10**6) == np.eye(200, dtype=bool)).all()
    assert not runs.shares_smaller([[5], [5]], 5).any() and runs.shares_smaller([], 5).shape == (0, 0)
    assert peak(lambda: runs.shares_smaller(lists, 10**7)) < 24 << 20


def test_groups_of_a_task_make_no_matrix_of_numbers():
    """2,000 rows in 8-byte numbers are 32 MB."""
    linked = np.zeros((2000, 2000), bool)
    linked[np.arange(1999), np.arange(1, 2000)] = linked[np.arange(1, 2000), np.arange(1999)] = True
    linked[700, 701] = linked[701, 700] = False
    assert (runs.labels_of(linked) == np.where(np.arange(2000) > 700, 701, 0)).all()
    assert peak(lambda: runs.labels_of(linked)) < 24 << 20
