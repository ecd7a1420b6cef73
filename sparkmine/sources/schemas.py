"""Explicit schemas of the CSV layouts the readers know (no inference pass needed)."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_INT, _LONG, _STR, _DBL, _DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.DateType()

USERS = _schema(("userId", _INT), ("foreName", _STR), ("surName", _STR), ("email", _STR))
MOVIES = _schema(("movieId", _INT), ("title", _STR), ("genres", _STR))
RATINGS = _schema(("userId", _INT), ("movieId", _INT), ("rating", _DBL), ("timestamp", _LONG))
TAGS = _schema(("userId", _INT), ("movieId", _INT), ("tag", _STR), ("timestamp", _LONG))
XY = _schema(("X", _DBL), ("Y", _DBL))
EXAM = _schema(("ImieNazwisko", _STR), ("OcenaC", _DBL), ("DataC", _DATE), ("OcenaCpp", _DBL), ("Egzamin", _DBL))
GRID = _schema(("ImieNazwisko", _STR), ("OcenaC", _DBL), ("DataC", _DATE), ("OcenaCpp", _DBL))
BOOKS = _schema(("author", _STR), ("work", _STR), ("content", _STR), ("content_stemmed", _STR))
TWEETS = _schema(("Entity", _STR), ("Sentiment", _STR), ("TweetContent", _STR))
BIKE_DAYS = _schema(
    ("instant", _INT), ("dteday", _DATE), ("season", _INT), ("yr", _INT), ("mnth", _INT), ("holiday", _INT),
    ("weekday", _INT), ("workingday", _INT), ("weathersit", _INT), ("temp", _DBL), ("atemp", _DBL), ("hum", _DBL),
    ("windspeed", _DBL), ("casual", _INT), ("registered", _INT), ("cnt", _INT),
)
