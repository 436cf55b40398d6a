"""Small hand-made tables."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from footfall import schemas

DAY = datetime(2024, 3, 1, 9, 0, 0)


def action(session, second=0, user=1, page=1, day=0, **columns):
    at = DAY + timedelta(days=day, seconds=second)
    row = {
        "date": at.date(),
        "user_id": user,
        "session_id": session,
        "page_id": page,
        "action_time": at,
        "city_id": 1,
    }
    row.update(columns)
    return tuple(row.get(name) for name in schemas.USER_VISIT_ACTION.names)


def actions(spark, rows):
    return spark.createDataFrame(rows, schemas.USER_VISIT_ACTION)


def users(spark, rows):
    """Rows of (user_id, age, professional, city, sex)."""
    full = [(u, f"user{u}", f"name{u}", age, job, city, sex) for u, age, job, city, sex in rows]
    return spark.createDataFrame(full, schemas.USER_INFO)


def clicks(spark, rows):
    """Rows of (minute, province, city, user, ad)."""
    base = datetime(2024, 3, 1, 0, 0, 0)
    full = [
        (base + timedelta(minutes=m), (base + timedelta(minutes=m)).date(), p, c, u, a)
        for m, p, c, u, a in rows
    ]
    return spark.createDataFrame(full, schemas.AD_CLICK)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def texts(df):
    return df.select([F.col(c).cast("string") for c in df.columns])
