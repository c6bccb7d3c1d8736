"""Raw arrivals to clean arrivals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from landfall import schemas
from landfall.functions import codes, days


def clean_arrivals(raw: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Decode, rename and cast in one projection of native expressions; columns of `raw` in
    `also` stay.

    Values that do not fit their type become NULL. Year and month are those of
    the filing, the day that of the arrival; they can disagree and are kept.
    """
    col = F.col
    derived = {
        "age": codes.whole(col("i94bir")),
        "country_code": codes.code_text(col("i94cit")),
        "port_code": col("i94port").cast("string"),
        "mode": codes.decode_mode(col("i94mode")),
        "visa_category": codes.decode_visa(col("i94visa")),
        "visatype": col("visatype"),
        "gender": col("gender"),
        "birth_year": codes.whole(col("biryear")),
        "arrdate": col("arrdate"),
        "arrival_date": days.sas_date(col("arrdate")),
        "depdate": col("depdate"),
        "departure_date": days.sas_date(col("depdate")),
        "year": codes.whole(col("i94yr")),
        "month": codes.whole(col("i94mon")),
        "arrival_day": days.sas_day_of_month(col("arrdate")),
    }
    return raw.select(*[derived[c].alias(c) for c in schemas.CLEAN_ARRIVALS.fieldNames()],
                      *also)
