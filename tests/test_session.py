"""Concurrent submission of independent table jobs."""

import threading
import time

import pytest

from starloom.session import run_concurrently


def test_all_actions_finish_before_an_error_is_raised():
    done = []

    def slow(name):
        def f():
            time.sleep(0.2)
            done.append(name)
            return name
        return f

    def boom():
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError, match="boom"):
        run_concurrently({"a": slow("a"), "bad": boom, "b": slow("b")})
    assert sorted(done) == ["a", "b"]


def test_results_by_name_and_sequential_mode():
    threads = set()

    def f(v):
        def g():
            threads.add(threading.get_ident())
            return v
        return g

    assert run_concurrently({"x": f(1), "y": f(2)}) == {"x": 1, "y": 2}
    threads.clear()
    assert run_concurrently({"x": f(1), "y": f(2)}, parallel=1) == {"x": 1, "y": 2}
    assert threads == {threading.get_ident()}


def test_spark_jobs_from_threads(spark):
    out = run_concurrently({n: (lambda n=n: spark.range(n * 1000).count()) for n in (1, 2, 3)},
                           spark=spark)
    assert out == {1: 1000, 2: 2000, 3: 3000}


def test_first_failure_cancels_sibling_spark_jobs(spark):
    def slow_job():
        # 160 tasks of 0.5 s on 8 cores: about 10 s unless cancelled
        spark.range(0, 160, 1, 160).foreach(lambda r: time.sleep(0.5))

    def fails_fast():
        time.sleep(1.0)
        raise ValueError("first")

    t = time.perf_counter()
    with pytest.raises(ValueError, match="first"):
        run_concurrently({"slow": slow_job, "bad": fails_fast}, spark=spark)
    assert time.perf_counter() - t < 7
