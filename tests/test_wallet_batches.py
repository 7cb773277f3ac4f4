"""What payments of a batch multiply is not spread over the tasks again."""

from __future__ import annotations

from pyspark.sql import functions as F

from __spark_entry__ import queries
from parcelledger.plans import wallet


def test_waybills_of_batches_are_ranked_without_their_payments(spark, small, monkeypatch):
    seen, ranked_with_totals = [], wallet.ranked_with_totals

    def record(df, **arguments):
        seen.append(df)
        return ranked_with_totals(df, **arguments)

    monkeypatch.setattr(wallet, "ranked_with_totals", record)
    rows = queries()["wallet_transactions"](spark, small)
    (ranked,) = seen
    assert "tx_no" not in ranked.columns
    # A row a waybill of a batch; a batch has several payments here, each with all of them.
    assert ranked.count() * 2 < rows.filter("batch_rank is not null").count()


def test_totals_over_payments_of_several_statuses(spark):
    """Statuses that no payment has do not count, and a total without any value is null."""
    names = [*(f"n_{s}" for s in ("03", "04", "06", "")), *(f"all_{s}" for s in ("03", "04", "06", ""))]
    cases = [((1, 2, 0, 3), ("1.5", "2", "100", "-4")), ((0, 2, 0, 0), ("1", None, "1", "1")), ((1, 1, 0, 0), (None, "7", None, None))]
    kinds = ", ".join([*(f"`{n}` long" for n in names[:4]), *(f"`{n}` string" for n in names[4:])])
    df = spark.createDataFrame([n + v for n, v in cases], kinds)
    df = df.withColumns({n: F.col(n).cast("decimal(28,4)") for n in names[4:]})
    found = [r[0] for r in df.select(wallet._over_payments("all")).collect()]
    assert [None if x is None else float(x) for x in found] == [-6.5, None, 7.0]
