"""Declared schemas, bin edges and feature groups."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


_ID, _CODE, _NUM, _TEXT = LongType, IntegerType, DoubleType, StringType

TRAIN = _schema(label=_CODE, clickTime=_CODE, conversionTime=_CODE, creativeID=_ID, userID=_ID,
                positionID=_ID, connectionType=_CODE, telecomsOperator=_CODE)
TEST = _schema(instanceID=_ID, label=_CODE, clickTime=_CODE, creativeID=_ID, userID=_ID,
               positionID=_ID, connectionType=_CODE, telecomsOperator=_CODE)
AD = _schema(creativeID=_ID, adID=_ID, camgaignID=_ID, advertiserID=_ID, appID=_ID, appPlatform=_CODE)
APP_CATEGORY = _schema(appID=_ID, appCategory=_CODE)
POSITION = _schema(positionID=_ID, sitesetID=_CODE, positionType=_CODE)
USER = _schema(userID=_ID, age=_CODE, gender=_CODE, education=_CODE, marriageStatus=_CODE,
               haveBaby=_CODE, hometown=_CODE, residence=_CODE)
USER_APP = _schema(userID=_ID, appID=_ID)
ACTION = _schema(userID=_ID, installTime=_CODE, appID=_ID)
TRAJECTORY = _schema(intersection_id=_TEXT, tollgate_id=_CODE, starting_time=TimestampNTZType,
                     travel_time=_NUM)
WEATHER = _schema(date=DateType, hour=_CODE, pressure=_NUM, sea_pressure=_NUM, wind_direction=_NUM,
                  wind_speed=_NUM, temperature=_NUM, rel_humidity=_NUM, precipitation=_NUM)

# Bin edges, category codes and sentinels of the data model, the weather columns, and the features of each group.
APP_POPULARITY_EDGES = [10 ** power for power in range(8)]
USER_ACTIVITY_EDGES = [1, 4, 16, 64, 252, 1000]
AGE_EDGES = [0, 1, 4, 14, 29, 44, 59, 74, 84]
CLICK_COUNT_EDGES = [1, 28, 44, 120]
CONVERSION_DELAY_EDGES = [0, 1000, 2500, 4000, 5500, 7000]
UNKNOWN_CODE = 0
POPULARITY_WHEN_MISSING = 6
ACTIVITY_WHEN_MISSING = 5
CATEGORY_WHEN_MISSING = 0
DELAY_WHEN_MISSING = 5
LAST_SETTLED_CLICK_TIME = 260000
WEATHER_COLUMNS = ["pressure", "sea_pressure", "wind_direction", "wind_speed", "temperature",
                   "rel_humidity", "precipitation"]
CONTEXT_FEATURES = ["sitesetID", "positionType", "connectionType", "telecomsOperator", "hour",
                    "hour_weight", "is_pref_cat"]
USER_FEATURES = ["age", "gender", "education", "marriageStatus", "haveBaby", "hometown", "residence",
                 "user_activity", "cat_pref"]
AD_FEATURES = ["advertiserID", "appPlatform", "appCategory", "app_popularity"]
