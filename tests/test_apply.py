"""A caller's function over every record, failures as data."""

from assay.operators.apply import apply_with_errors, rows_of_keys, rows_of_records


def test_callers_function_and_its_failures(spark):
    df = spark.createDataFrame([(1, "4", 2), (2, "x", 1), (3, "9", 0), (4, None, 1)], "id int, a string, b int")
    got = {r.id: (r.result, r.error) for r in apply_with_errors(df, lambda a, b: int(a) // b, ["a", "b"], "bigint", ["id"]).collect()}
    assert got[1] == (2, None)
    assert got[2][0] is None and got[2][1].startswith("ValueError: invalid literal")
    assert got[3][1].startswith("ZeroDivisionError") and got[4][1].startswith("TypeError")


def test_structured_results_and_empty_frames(spark):
    df = spark.createDataFrame([(1, "a b c")], "id int, t string")
    out = apply_with_errors(df, lambda t: t.split(" "), ["t"], "array<string>", ["id"], result="words")
    assert out.columns == ["id", "words", "error"] and list(out.first().words) == ["a", "b", "c"]
    assert apply_with_errors(df.where("false"), len, ["t"], "int", ["id"]).count() == 0


def test_rows_of_keys_in_order_with_errors(spark):
    import random

    rng = random.Random(1)
    data = [(rng.choice([1, 2, 3, None]), i, rng.choice(["a", "bb", "", "x", None])) for i in range(300)]

    def make():
        seen = []

        def run(o, t):
            seen.append(t)
            if t == "x":
                raise ValueError(f"bad {o}")
            for k in range(len(t)):
                yield o, k + len(seen)
            if t == "bb":
                raise KeyError("late")

        return run

    want = []
    for key in {d[0] for d in data}:
        fn, n = make(), 0
        for _, o, t in sorted((d for d in data if d[0] == key), key=lambda d: d[1]):
            try:
                for a, b in fn(o, t):
                    want.append((key, n, a, b, None))
                    n += 1
            except Exception as e:
                want.append((key, n, None, None, f"{type(e).__name__}: {e}"))
                n += 1
    for parts in (1, 5):
        df = spark.createDataFrame(data, "k int, o int, t string").repartition(parts)
        got = [tuple(r) for r in rows_of_keys(df, make, ["k"], ["o"], ["o", "t"], "a int, b int").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert rows_of_keys(df.where("false"), make, ["k"], ["o"], ["o", "t"], "a int, b int").count() == 0


def test_rows_of_records(spark):
    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None), (4, "c!")], "seq int, t string").withColumnRenamed("seq", "id")

    def letters(t):
        for c in t:
            if c == "!":
                raise ValueError("no")
            yield (c,)

    got = sorted(map(tuple, rows_of_records(df, letters, ["t"], "c string", ["id"]).collect()))
    assert got[:3] == [(1, 0, "a", None), (1, 1, "b", None), (3, 0, None, "TypeError: 'NoneType' object is not iterable")]
    assert got[3:] == [(4, 0, "c", None), (4, 1, None, "ValueError: no")]
