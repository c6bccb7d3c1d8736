import datetime
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from landfall import schemas  # noqa: E402
from landfall.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        8, **{"spark.checkpoint.dir": str(shared),
              "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
              "spark.sql.shuffle.partitions": "3"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    """A fresh path per call."""
    return lambda name: str(tmp_path / f"{name}-{uuid.uuid4().hex[:6]}")


@pytest.fixture
def staging(spark):
    """Clean arrivals from (day, country_code, port_code[, depdate]) tuples."""
    epoch = datetime.date(1960, 1, 1)

    def make(*rows):
        data = []
        for day, country, port, *rest in rows:
            number = float((day - epoch).days)
            depdate = rest[0] if rest else None
            departed = (None if depdate is None
                        else epoch + datetime.timedelta(days=int(depdate)))
            data.append((30, country, port, "Air", "Pleasure", "B2", "F", 1966, number, day,
                         depdate, departed, day.year, day.month, day.day))
        from landfall.sources.readers import with_load_day
        return with_load_day(spark.createDataFrame(data, schemas.CLEAN_ARRIVALS))

    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda t: tuple((v is not None, str(v)) for v in t))
