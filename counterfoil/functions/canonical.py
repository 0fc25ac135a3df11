"""One comparable text per JSON document, from its text or from typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING = r'"(?:[^"\\]|\\.)*"'
#: What a document consists of: keys with their colon, texts, numbers, words, empty objects and other signs.
_TOKEN = rf"(?s){_STRING}\s*:|{_STRING}|-?[0-9][0-9.eE+-]*|[a-z]+|\{{\s*\}}|[^\s]"
#: Numbers as they are written behind an exponent or with a decimal point, outside texts.
_NUMBER_TOKEN = rf"(?s){_STRING}|-?[0-9][0-9.E+-]*|[^\"0-9-]+"
_BLANK = r"(?<!\\)((?:\\\\)*)\\u0020"


def allow_repeated_keys(spark: SparkSession) -> None:
    """Of keys that are equal, or become so without their spaces, the last one counts; JSON may have them."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _needs_tokens(doc: Column) -> Column:
    """Whether a quote may be escaped, or there is space that JSON does not have."""
    return doc.contains("\\") | doc.contains("\x0b") | doc.contains("\x0c")


def _cut_at_quotes(doc: Column) -> Column:
    """The stripped document, of one without escapes: every second piece between quotes is a text, a key before a colon."""
    def bare(piece: Column, place: Column) -> Column:
        return F.when(place % 2 == 1, piece).otherwise(F.translate(piece, " \t\r\n", ""))

    def plain(pieces: Column) -> Column:
        def one(piece: Column, place: Column) -> Column:
            key = F.get(pieces, place + 1).startswith(":")
            words = F.replace(F.replace(piece, F.lit("true"), F.lit("1")), F.lit("false"), F.lit("0"))
            return (
                F.when(place % 2 == 0, F.replace(words, F.lit("{}"), F.lit("[]")))
                .when(key, F.replace(piece, F.lit(" "), F.lit("")))
                .otherwise(piece)
            )

        return F.array_join(F.transform(pieces, one), '"')

    # Inside the outer lambda the pieces are a value; as an expression they would be cut anew for each piece.
    return F.transform(F.array(F.transform(F.split(doc, '"'), bare)), plain)[0]


#: A key with a space in it, and a quote before a colon that may begin a text; of documents without escapes.
_SPACED_KEY = r'"[^" ]*+ [^"]*+"\s*+:'
_UNCLEAR = r'(?:^|[\[{,:])\s*+"\s*+:'


def _needs_pieces(doc: Column) -> Column:
    """Whether there may be more to change than spaces in keys, or a text could look like the end of a key."""
    return doc.contains("true") | doc.contains("false") | doc.rlike(r"\{\s*+\}") | doc.rlike(_UNCLEAR)


def _keys_stripped(doc: Column) -> Column:
    """The document, whose few different keys are replaced as a whole."""
    keys = F.array_distinct(F.regexp_extract_all(doc, F.lit(_SPACED_KEY), F.lit(0)))
    return F.aggregate(keys, doc, lambda text, key: F.replace(text, key, F.replace(key, F.lit(" "), F.lit(""))))


def canonical_document(doc: str | Column) -> Column:
    """Keys lose their spaces, objects lose their order, equal numbers look equal; no row leaves the JVM.

    The document is cut into tokens, of which keys are stripped; true and false become 1 and 0 and an empty object an empty
    array, as the comparison this replaces has it. Where nothing is escaped the quotes alone are the cuts, or keys are found by their colon. Parsed as a
    variant, objects are sorted and decimals lose their zeros; what is still written with an exponent is a whole number, if
    it is one of up to 37 digits.
    """
    doc = F.col(doc) if isinstance(doc, str) else doc
    token = F.regexp_extract_all(doc, F.lit(_TOKEN), F.lit(0))

    def plain(t: Column) -> Column:
        text = t.startswith('"')
        key = F.regexp_replace(F.regexp_replace(F.replace(t, F.lit(" "), F.lit("")), _BLANK, "$1"), r"\s+:$", ":")
        return (
            F.when(text & t.endswith(":"), key)
            .when(text, t)
            .when(t == "true", "1")
            .when(t == "false", "0")
            .when(t.startswith("{") & (F.length(t) > 1), "[]")
            .otherwise(t)
        )

    def number(t: Column) -> Column:
        value = t.cast("double")
        whole = (value == F.rint(value)) & (F.abs(value) < 1e37)
        return F.when(
            t.rlike(r"^-?[0-9]+(\.[0-9]+)?E") & whole, value.cast("decimal(38,0)").cast("string")
        ).when(t.rlike(r"^-?[0-9]+\.0$"), F.regexp_replace(t, r"\.0$", "")).otherwise(t)

    cut = F.when(_needs_tokens(doc), F.array_join(F.transform(token, plain), "")).when(
        _needs_pieces(doc), _cut_at_quotes(doc)
    ).otherwise(_keys_stripped(doc))
    sorted_ = F.to_json(F.parse_json(cut))

    def tidy(text: Column) -> Column:
        numbers = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_NUMBER_TOKEN), F.lit(0)), number), "")
        return F.when(text.rlike(r"[0-9](\.0|E)"), numbers).otherwise(text)

    # Named by a lambda, the text is made once; as an expression it would be parsed again for each use.
    return F.transform(F.array(sorted_), tidy)[0]


def _leaf(value: Column, kind: T.DataType) -> Column:
    """A scalar as text behind its kind: equal numbers of different types are equal, 1 and "1" are not."""
    if isinstance(kind, T.BooleanType):
        return F.concat(F.lit("n"), value.cast("int").cast("string"))
    if isinstance(kind, T.DecimalType):
        text = value.cast("string")
        return F.concat(F.lit("n"), F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e18)
        return F.concat(F.lit("n"), F.when(whole, value.cast("long").cast("string")).otherwise(value.cast("string")))
    if isinstance(kind, T.NumericType):
        return F.concat(F.lit("n"), value.cast("string"))
    if isinstance(kind, T.TimestampType):
        return F.concat(F.lit("s"), F.date_format(value, "yyyy-MM-dd HH:mm:ss"))
    return F.concat(F.lit("s"), value.cast("string"))


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = {field.name.replace(" ", ""): field for field in kind}
        parts = [_typed(value[fields[name].name], fields[name].dataType).alias(name) for name in sorted(fields)]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _typed(item, kind.elementType))
    return _leaf(value, kind)


def canonical_columns(df: DataFrame) -> Column:
    """The same for documents that are still columns: the schema is stripped and sorted once, no row is parsed.

    Numbers are compared exactly, not as floating point; texts of both forms are not comparable with each other.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    return F.to_json(_typed(whole, df.schema), {"ignoreNullFields": "false"})
