import threading

from riskloom.operators.rollup import run_sections


def test_sections_run_side_by_side(spark):
    together = threading.Barrier(3, timeout=20)

    def broken():
        together.wait()
        raise ValueError("no such thing")

    done, errors = run_sections({"a": together.wait, "b": broken, "c": lambda: (together.wait(), spark.range(5).count())[1]})
    assert set(done) == {"a", "c"} and done["c"] == 5
    assert errors == {"b": "ValueError: no such thing"}
