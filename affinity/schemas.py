"""Fixed schemas of the tables."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _of(**fields) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


LINKS = _of(movieId=IntegerType, imdbId=IntegerType, tmdbId=IntegerType)
MOVIES = _of(movieId=IntegerType, title=StringType, genres=StringType)
RATINGS = _of(userId=IntegerType, movieId=IntegerType, rating=DoubleType, timestamp=IntegerType)
TAGS = _of(userId=IntegerType, movieId=IntegerType, tag=StringType, timestamp=IntegerType)
USER_RATING = _of(userId=IntegerType, movieId=IntegerType, rating=DoubleType)
RESULT = _of(userId=IntegerType, rank=IntegerType, movieId=IntegerType, rating=DoubleType)
MESSAGE = _of(key=StringType, value=StringType)

TABLES = {"links": LINKS, "movies": MOVIES, "ratings": RATINGS, "tags": TAGS}
