"""Dates in text of no fixed format, as pandas reads them."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from boxoffice.functions.dates import parse_date

FORMS = """1990-05-03|1990-05-03 10:00|05/03/1990 10:00:00|1990-05-03 10:00:00.123456|1990-05-03T10:00:00Z|1990-05-03T10
1990-05-03 10:00:00+07:00|1990-05-03 10:00:00 +0700|1990-05-03 10:00 UTC|1990-05-03 10:00 GMT|1990-05-03 UTC|19900503
03.05.1990|13.05.1990|3-May-1990| 1990-05-03 |May 1990|1990-05|1990|03 Sept 1990|03 Sep 1990|5/3/90|13/5/90|90-05-03
Mon, 03 May 1990|Monday 3 May 1990|May 3 1990|May 3, 1990 10:00 PM|3 may 1990|3 MAY 1990|1990/5/3|1990.05.03|1990 05 03
03 05 1990|5-3-1990|31/12/1990|12/31/1990|32/12/1990|1990-13-01|1990-13-05|1990-31-01|n/a|nan|NaT||null
1990-05-03 25:00|0001-01-01|1677-01-01|2300-01-01|9999-12-31|1990-02-30|29/02/2001|29/02/2000|May-03-1990|May/03/1990
1990-May-03|1990 May 3|3rd May 1990|May 3rd, 1990|1st June 2001|03/05/1990 10:00 AM|03/05/1990 10 AM|03/05/1990 10pm
1990-05-03 10|199005|9005|900503|199005031000|19900503100000|19900503T100000|0|5|12|1.5|1990.5|5/1990|05-1990|1990Q1
1990Q3|Q1 1990|2000-W01-1|2000-W01|1990-123|3/5|May|3 May|May 3|2/29/1900|00/00/0000|0000-00-00|00-05-1990|1-1-1
12/12/12|31-12-99|99-12-31|69-01-01|68-01-01|1/2/70|1/2/69|1/2/49|1/2/50|1/2/75|1/2/76|September 3, 1990
3 September 1990|Sept. 3, 1990|Sep. 3, 1990|3 de mayo de 1990|3,5,1990|3/5/1990,|1990-5-3|1990-5-03|05031990|5031990
1990-05-03 24:00|1990-05-03 10:60|1990-05-03 10:00:60|May 03 90|03 May 90|03-May-90|1990 3 May|12:00 05/03/1990
10:00:00 3 May 1990|1990-05-03-10|1990_05_03|5/3/1990 at 10:00|born 1990-05-03|1990-05-03 (approx)|1990/13/05|1990/31/12
13 May 1990 13:00 PM|1990-05-03 0:30 am|12 March 1985 12:15 am|2004-02-29T23:59:59.999999|7 Aug 2011 8:05""".replace("\n", "|").split("|")

#: What pandas takes from the clock or from another notation and this library does not read.
REFUSED = ["today", "now", "10:00"]


def by_pandas(text):
    got = pd.to_datetime(pd.Series([text]), format="mixed", errors="coerce")[0]
    return None if pd.isna(got) else got.date()


def read(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    rows = df.select("i", parse_date(F.col("t"), dt.date.today().year).alias("d")).collect()
    return {texts[r.i]: r.d for r in rows}


def test_forms(spark):
    got = read(spark, FORMS)
    assert {t: d for t, d in got.items() if d != by_pandas(t)} == {}


def test_refused_and_absent(spark):
    assert set(read(spark, [*REFUSED, None]).values()) == {None}


def test_random_dates_in_random_forms(spark):
    rng = random.Random(7)
    patterns = ["%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%d.%m.%y", "%d %b %Y", "%B %d, %Y", "%Y%m%d", "%y-%m-%d", "%a %d %b %Y"]
    times = ["", " %H:%M", " %H:%M:%S", " %I:%M %p", "T%H:%M:%S", " %H:%M:%S.%f"]
    texts = []
    for _ in range(400):
        day = dt.datetime(1930, 1, 1) + dt.timedelta(days=rng.randrange(35_000), seconds=rng.randrange(86_400))
        texts.append(day.strftime(rng.choice(patterns) + rng.choice(times)))
    got = read(spark, texts)
    assert {t: (d, by_pandas(t)) for t, d in got.items() if d != by_pandas(t)} == {}
