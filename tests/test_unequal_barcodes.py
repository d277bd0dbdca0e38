import random

from cellamp.operators import whitelist


def test_letters_of_the_longer_barcode_are_mismatches(spark):
    rng = random.Random(4)
    draw = lambda n, letters: sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(n)})
    obs, wl = [*draw(60, "ACN"), "", "A"], [*draw(40, "AC"), "CA"]
    a = spark.createDataFrame([*((b,) for b in obs), (None,)], "bc string")
    b = spark.createDataFrame(list(zip(wl, range(len(wl)))), "bc string, wl_idx bigint")
    dist = lambda x, y: sum(p != q for p, q in zip(x, y)) + abs(len(x) - len(y))
    want = sorted((x, y, dist(x, y)) for x in obs for y in wl if dist(x, y) <= 2)
    got = sorted((r.obs, r.bc, r.distance) for r in whitelist.hamming_join(a, b, 2, 6).collect())
    assert got == want and any(len(x) != len(y) for x, y, _ in want)
