"""Token counts and the sequence length cap."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loomset.functions.text import fresh, ref

Tokenizer = Callable[[str], list]


def token_cap(
    df: DataFrame,
    max_seq_length: int = 512,
    column: str = "text",
    make_tokenizer: Callable[[], Tokenizer] | None = None,
    token_type: str = "string",
) -> DataFrame:
    """Add ``tokens`` (at most ``max_seq_length``), ``n_tokens`` and ``truncated``.

    The default tokens are runs of non-space characters, not a model's
    subwords; pass ``make_tokenizer`` for those. It is called once per Python
    task, only the text column travels to it, and only capped tokens and the
    count come back. The count is of the whole text.
    """
    text = F.coalesce(ref(column), F.lit(""))
    if make_tokenizer is None:
        counted = df.withColumn("tokens", _leading_tokens(text, max_seq_length)).withColumn("n_tokens", token_count(text))
    else:
        name = fresh(df, "tokenized")
        counted = df.withColumn(name, _tokenize_udf(make_tokenizer, token_type, max_seq_length)(text))
        counted = counted.withColumns({"tokens": F.col(name)["tokens"], "n_tokens": F.col(name)["n_tokens"]}).drop(name)
    return counted.withColumn("truncated", F.col("n_tokens") > max_seq_length)


def token_count(text: Column) -> Column:
    """Runs of non-space characters."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def _leading_tokens(text: Column, n: int) -> Column:
    """The first n runs of non-space characters; the rest of the text stays in one piece."""
    pieces = F.split(F.regexp_replace(text, r"^\s+", ""), r"\s+", n + 1)
    return F.filter(F.slice(pieces, 1, n), lambda token: token != "")


def _tokenize_udf(make_tokenizer: Callable[[], Tokenizer], token_type: str, most: int):
    token = T.StructType.fromDDL(f"token {token_type}").fields[0].dataType
    result = T.StructType([T.StructField("tokens", T.ArrayType(token)), T.StructField("n_tokens", T.LongType())])
    arrow_type = to_arrow_type(result)

    def tokenize(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = make_tokenizer()
        for texts in batches:
            found = map(tokenizer, texts.to_pylist())
            yield pa.array([{"tokens": t[:most], "n_tokens": len(t)} for t in found], type=arrow_type)

    return F.arrow_udf(tokenize, result)


def length_report(
    df: DataFrame,
    by: str | Sequence[str] = (),
    max_seq_length: int = 512,
    column: str = "text",
    percentiles: Sequence[int] = (50, 90, 99),
    n_tokens: Column | None = None,
) -> DataFrame:
    """Token counts per group, to choose a length by: rows, tokens, longest, mean, rows above the cap, tokens lost to it.

    ``p<k>_tokens`` is the least count that at least k hundredths of the group's rows don't exceed,
    exactly. Tokens are those of ``token_cap``'s default; nulls are empty texts. ``n_tokens``
    gives each row's count instead, such as the column that ``token_cap`` adds for a model's subwords.
    Everything comes from a histogram, rows by group and count, that tasks sum
    up before the shuffle: a group of many rows has no more of it than it has different counts.
    """
    wrong = [k for k in percentiles if not 0 < k <= 100 or int(k) != k]
    if wrong:
        raise ValueError(f"percentiles are whole numbers from 1 to 100, not {wrong}")
    groups = [ref(c) for c in ([by] if isinstance(by, str) else by)]
    counted = token_count(F.coalesce(ref(column), F.lit(""))) if n_tokens is None else F.coalesce(n_tokens, F.lit(0)).cast("long")
    names = [fresh(df, name) for name in ("n_tokens", "rows", "so_far", "all_rows")]
    n, rows, so_far, all_rows = (F.col(name) for name in names)
    histogram = df.select(*groups, counted.alias(names[0])).groupBy(*groups, names[0]).agg(F.count(F.lit(1)).alias(names[1]))
    group = Window.partitionBy(*groups)
    upto = group.orderBy(n).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = histogram.withColumns({names[2]: F.sum(rows).over(upto), names[3]: F.sum(rows).over(group)})
    return running.groupBy(*groups).agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("num_rows"),
        F.coalesce(F.sum(n * rows), F.lit(0)).alias("num_tokens"),
        F.max(n).alias("max_tokens"),
        (F.sum(n * rows) / F.sum(rows)).alias("mean_tokens"),
        F.coalesce(F.sum(F.when(n > max_seq_length, rows)), F.lit(0)).alias("num_truncated"),
        F.coalesce(F.sum(F.greatest(n - max_seq_length, F.lit(0)) * rows), F.lit(0)).alias("tokens_cut"),
        *[F.min(F.when(so_far * 100 >= all_rows * int(k), n)).alias(f"p{int(k)}_tokens") for k in percentiles],
    )


def tokenizer_file(path: str, add_special_tokens: bool = True) -> Callable[[], Tokenizer]:
    """For ``make_tokenizer``: a model's subword ids from its ``tokenizer.json``.

    The file must be readable at this path on every executor.
    """

    def make() -> Tokenizer:
        from tokenizers import Tokenizer as FileTokenizer

        loaded = FileTokenizer.from_file(path)
        loaded.no_truncation()
        return lambda text: loaded.encode(text, add_special_tokens=add_special_tokens).ids

    return make
