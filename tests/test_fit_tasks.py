"""Tasks of an iterative fit."""

from prelaunch.plans import pipeline as PL


def test_a_pass_over_millions_of_rows_has_few_tasks():
    assert PL.fit_tasks(5_330_470, 12) <= 60          # 267 before: in 1,200 dependent passes they cost more than their rows
    assert 5_330_470 / PL.fit_tasks(5_330_470, 12) <= PL.ROWS_PER_TASK


def test_small_inputs_keep_their_tasks():
    assert [PL.fit_tasks(n, 8) for n in (0, 1_999, 4_000, 88_808, 160_000)] == [1, 1, 2, 8, 8]


def test_a_pass_over_millions_of_rows_takes_one_wave_of_tasks():
    assert PL.fit_tasks(5_330_470, 12) == 12          # 54 before
    assert PL.fit_tasks(50_000_000, 12) == 100
