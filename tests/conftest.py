import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kandela.session import get_session
    s = get_session("kandela-tests", master="local[4]", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.driver.memory": "4g"})
    # tests only: a private checkpoint folder (clusters name a shared one)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kandela-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="kandela-test-")


def bar_rows(closes, start="2024-01-01 00:00:00", step_minutes=1, symbol=None, volume=1.0,
             gaps=()):
    """Candle rows with the given closes, one per step (``gaps`` = indices
    after which one extra step is skipped)."""
    import datetime as dt
    t = dt.datetime.fromisoformat(start)
    rows = []
    for i, c in enumerate(closes):
        r = dict(open_time=t, open=c, high=c, low=c, close=c, volume=volume,
                 close_time=t + dt.timedelta(minutes=step_minutes) - dt.timedelta(milliseconds=1),
                 quote_asset_volume=volume * (c if c is not None and c == c else 0.0), number_of_trades=1,
                 taker_buy_base_volume=volume / 2, taker_buy_quote_volume=0.0)
        if symbol is not None:
            r = {"symbol": symbol, **r}
        rows.append(r)
        t += dt.timedelta(minutes=step_minutes * (2 if i in gaps else 1))
    return rows


def bars_df(spark, rows, keyed=False):
    from kandela.schema import BRONZE, with_keys
    schema = with_keys(BRONZE) if keyed else BRONZE
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
