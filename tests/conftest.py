import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodgegrid.schemas import LISTING_SCHEMA, PRICE_TYPE  # noqa: E402
from lodgegrid.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def listings(spark):
    """Builds a listing frame from dicts; anything not given takes a plain default."""
    from decimal import Decimal

    default = {
        "id": 1, "host_id": "h", "host_name": "n", "host_is_superhost": "f",
        "host_neighbourhood": "s", "neighbourhood_cleansed": "A",
        "host_neighbourhood_cleansed": "L", "property_type": "Flat", "room_type": "Entire",
        "has_availability": "t", "month": "May", "year_month": 202005, "year": 2020,
        "accommodates": 2, "availability_30": 20, "number_of_reviews": 1,
        "review_scores_rating": 90.0, "price": 100,
    }

    def build(*rows):
        full = []
        for row in rows:
            values = default | row
            if values["price"] is not None:
                values["price"] = Decimal(str(values["price"])).quantize(Decimal("0.01"))
            full.append(tuple(values[f.name] for f in LISTING_SCHEMA))
        assert LISTING_SCHEMA["price"].dataType == PRICE_TYPE
        return spark.createDataFrame(full, LISTING_SCHEMA)

    return build


def rows(df, *columns):
    """The frame's rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
