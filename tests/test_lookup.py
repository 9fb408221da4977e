"""Names of loggers found by part, as a loop over the loggers finds them."""

import random

from agrolith.operators import treatment as T


def test_lookup_is_the_loop(spark):
    rng = random.Random(6)
    name = lambda: "".join(rng.choices("ab-7", k=rng.randrange(1, 7)))
    loggers, keys = [name() for _ in range(30)] + ["z6-03959", "z6-20917"], [name() for _ in range(80)] + ["z6", "z6-03959_2026", "none here", "한글"]
    for extra, also in (([], []), ([""], ["", None])):
        names = list(dict.fromkeys(loggers + extra))
        df = spark.createDataFrame([(x, i) for i, x in enumerate(loggers + extra + [None])], "logger string, place int")
        got = {r.key: r.logger for r in T.lookup(spark.createDataFrame([(k,) for k in keys + also], "key string"), df).collect()}
        want = {k: None if k is None else k if k in names else next((x for x in names if x in k or k in x), None) for k in keys + also}
        assert got == want
    assert T.lookup(spark.createDataFrame([("a",)], "key string"), df.where("false")).collect() == [("a", None)]
