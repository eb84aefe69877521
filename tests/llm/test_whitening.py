"""Whitened vectors against plain linear algebra."""

import numpy as np
import pytest

from tidemart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows):
    """Whitened rows, deviations and explained shares of complete vectors."""
    x = np.floor(64 * np.array(rows, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    off = (n * x - s) / n
    values, axes = np.linalg.eigh(off.T @ off / n)
    return off @ axes[:, ::-1] / np.sqrt(values[::-1]), ((n * x - s) ** 2).sum(axis=1), values[::-1] / values.sum()


@pytest.fixture(scope="module")
def table(spark, small):
    return spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding")


@pytest.mark.parametrize("components, rows_a_block", [(32, 1_024), (5, 16)])
def test_given_vectors(table, monkeypatch, components, rows_a_block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 32)
    rows = sorted(tuple(r) for r in table.collect())
    expected, deviations, shares = plain([v for _, v in rows])
    found = whitening.whiten(table, components).toPandas()
    assert len(found) == len(rows) * components and set(found.n) == {len(rows)}
    ids = [i for i, _ in rows]
    mine = found.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((mine * expected[:, :components]).sum(axis=0))
    assert np.abs(mine * sign - expected[:, :components]).max() < 1e-9
    first = found[found.component == 1].set_index("vec_id").loc[ids]
    assert first.deviation.tolist() == deviations.tolist()
    assert found.groupby("component").explained.first().to_numpy() == pytest.approx(shares[:components], rel=1e-9)
    cov = np.cov(mine.T, bias=True)
    assert found.identity_error.nunique() == 1
    assert found.identity_error.iloc[0] == pytest.approx(np.abs(cov - np.eye(components)).max(), abs=1e-10) and found.identity_error.iloc[0] < 1e-4


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 5.0]), (3, [float("nan"), 1.0]), (4, [1.0]), (5, [-1.0, 0.5]), (6, [None, 1.0]),
            (7, []), (8, None), (9, [float("inf"), 0.0])]
    df = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], SCHEMA + ", at string, whole double")
    found = whitening.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in found) == sorted(["1", "1", "1", "1", "None", "None", "5", "5"])
    assert {r.n for r in found} == {4}
    again = [r for r in found if r.vec_id == 1]
    assert len({(r.component, r.whitened, r.deviation) for r in again}) == 2
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.where("vec_id IN (3, 6, 7, 8, 9)")).collect() == []


def test_without_variance(spark):
    flat = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], SCHEMA)
    assert {(r.whitened, r.explained, r.identity_error, r.deviation) for r in whitening.whiten(flat).collect()} == {(None, None, None, 0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], SCHEMA)
    by = {r.component: r for r in whitening.whiten(line).collect() if r.vec_id == 4}
    assert by[1].explained == pytest.approx(1) and by[2].whitened is None and abs(by[1].identity_error) < 1e-9
    large = spark.createDataFrame([(1, [3e38, 0.0]), (2, [0.0, 1.0])], SCHEMA)
    assert {r.deviation for r in whitening.whiten(large).collect()} == {None}
