"""Fixed table schemas. Nothing in the library infers a schema."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L, _D, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampNTZType(),
)

# One row per link on a listing page; (page_no, pos) is the reading order.
LISTING = _struct(source=_S, page_no=_I, pos=_I, url=_S)

# Landed HTML: one row per (source, page_no) or per (source, url).
LISTING_PAGE = _struct(source=_S, page_no=_I, html=_S)
LANDED_PAGE = _struct(source=_S, url=_S, status=_I, html=_S)

ARTICLE = _struct(source=_S, title=_S, link=_S, content=_S, published_date=_TS)

# Stored articles also keep the date as the text the site printed; CSV has it as the date.
STORED_ARTICLE = T.StructType(ARTICLE.fields + _struct(date_text=_S).fields)

LABELLED = T.StructType(ARTICLE.fields + _struct(sentiment=_S, confidence=_D).fields)

RESULT = _struct(
    entity=_S,
    sentiment_score=_D,
    volume_score=_D,
    momentum=_D,
    mci_v2=_D,
    total_mentions=_L,
)


def tracked(entities: list[str]) -> T.StructType:
    """Article + full text + counts as a map and as one column per entity."""
    counts = T.MapType(T.StringType(), T.IntegerType(), valueContainsNull=False)
    extra = [T.StructField("full_text", _S), T.StructField("entity_counts", counts)]
    return T.StructType(ARTICLE.fields + extra + [T.StructField(e, _I) for e in entities])
