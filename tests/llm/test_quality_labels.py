"""Labels that contradict each other, columns of the classifier's names, and rates of sites against brute force."""

import numpy as np

from caremart.llm import quality


def test_conflicting_labels_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(k, ("good plain words in a row " if k % 2 else "XX !! 99 $$ ") * (k % 7 + 1), 1.0, "x") for k in range(60)],
        "doc_id long, text string, _Quality double, _toxic string")
    rows = [(k, k % 2, 0) for k in range(60)]
    twice = rows + [(k, 1, 0) for k in range(0, 60, 2)] + [(k, 1, 0) for k in range(1, 60, 2)]
    once = quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    both = [quality.fit(docs, spark.createDataFrame(twice[::step], "doc_id long, quality int, toxic int"))
            for step in (1, -1)]
    assert all(np.array_equal(once.weights, b.weights) and np.array_equal(once.bias, b.bias) for b in both)
    told = quality.evidence(docs, once)
    assert told.columns == ["doc_id", "text", "_quality", "_toxic"]
    assert all((r["_quality"] > 0.5) == (r["doc_id"] % 2 == 1) for r in told.collect())


def test_site_rates_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for host in range(6):
        level = rng.uniform(0.1, 0.9)
        rows += [(f"h{host}", f"p{rng.integers(0, 3)}", float(np.clip(rng.normal(level, 0.2), 0, 1)))
                 for _ in range(int(rng.integers(2, 40)))]
    rows += [(None, None, 0.3), ("h0", None, 0.9)]
    got = {(r["host"], r["path"]): (r["rate"], r["base"]) for r in quality.site_rates(
        spark.createDataFrame(rows, "host string, path string, quality double"), "quality").collect()}
    values = np.array([v for *_, v in rows])
    mean = values.mean()

    def worth(keys):
        """Prior's worth by the method of moments, from the values themselves."""
        groups = [values[[k == key for k in keys]] for key in set(keys)]
        n, k = len(values), len(groups)
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (n - k)
        between = sum(len(g) * (g.mean() - mean) ** 2 for g in groups) / (k - 1)
        spread = (between - within) / ((n - sum(len(g) ** 2 for g in groups) / n) / (k - 1))
        return min(quality.MOST_PRIOR, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else quality.MOST_PRIOR

    hosts, paths = [h for h, *_ in rows], [(h, p) for h, p, _ in rows]
    of_hosts, of_paths = worth(hosts), worth(paths)
    assert got.keys() == set(paths)
    for host, path in set(paths):
        own = values[[h == host for h in hosts]]
        host_rate = (own.sum() + mean * of_hosts) / (len(own) + of_hosts)
        own = values[[p == (host, path) for p in paths]]
        rate, base = got[host, path]
        assert abs(rate - (own.sum() + host_rate * of_paths) / (len(own) + of_paths)) < 1e-9 and abs(base - mean) < 1e-9
