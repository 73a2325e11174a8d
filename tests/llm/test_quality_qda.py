import math
import zlib

import numpy as np

from tidemill.llm import quality_qda

DATA = "/root/testdata/sf0.01"


def test_scores_match_the_written_out_densities():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (60, quality_qda.N_FEATURES)), rng.normal(0.7, 2, (90, quality_qda.N_FEATURES))])
    y = np.array([0] * 60 + [1] * 90)
    model = quality_qda.fit(x, y, 0.2)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    z = np.clip(z, -quality_qda.CLIP, quality_qda.CLIP)
    log = []
    for k in (0, 1):
        own = z[y == k]
        cov = np.cov(own.T, bias=True)
        cov = 0.8 * cov + 0.2 * np.trace(cov) / len(cov) * np.eye(len(cov))
        d = z - own.mean(axis=0)
        log.append(math.log(len(own) / len(z)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(log[0] - log[1])), atol=1e-9)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_qda.predictions(docs, labels)
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in out) / len(out) > 0.95
    assert got.count() == docs.count()


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word " * 50000, "x"), (3, "word " * 50000, "x"), (4, "ok fine.", None)], "doc_id long, text string, label string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_qda.predictions(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, None), (2, 7), (3, 1), (4, 1)], "doc_id long, quality int")
    got = quality_qda.predictions(docs, odd).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert quality_qda.predictions(docs.filter("doc_id > 9"), odd).collect() == []
    kept = quality_qda.keep_good(docs, odd)
    assert kept.columns == docs.columns and kept.count() <= 5
