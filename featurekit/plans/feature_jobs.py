"""The numbered feature jobs on a card-transaction table.

Each job takes the stacked train and test table (``dataset`` column, see :func:`joined_table`) and returns the key,
the dataset and its new columns, without prefix: the catalogue adds the job number. A job first narrows the table to
the columns it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.functions import calendar, numeric, text, values
from featurekit.operators import columns, encoders, groups, lags
from featurekit.operators.lookup import left_join, with_row_id
from featurekit.operators.sets import stack_datasets

KEY, DATASET, LABEL, SECONDS = "TransactionID", "dataset", "isFraud", "TransactionDT"

# Value and key columns of the group ratios.
RATIO_VALUES = ["TransactionAmt", "id_02", "D15"]
RATIO_KEYS = ["card1", "card4"]
RATIO_EXTRA_KEYS = ["addr1", "addr2"]

# Column pairs whose joined text becomes a code.
PAIRS = [
    ("id_02", "id_20"), ("id_02", "D8"), ("D11", "DeviceInfo"), ("DeviceInfo", "P_emaildomain"), ("P_emaildomain", "C2"),
    ("card2", "dist1"), ("card1", "card5"), ("card2", "id_20"), ("card5", "P_emaildomain"), ("addr1", "card1"),
]

# Columns counted over both datasets, and per dataset.
COUNTED_FULL = ["id_34", "id_36"]
COUNTED_PER_DATASET = ["id_01", "id_31", "id_33", "id_35", "id_36"]

# Columns of the large count-encoding job.
COUNT_ENCODED = [
    "ProductCD", "card2", "card3", "card4", "card5", "card6", "addr1", "addr2", "P_emaildomain", "R_emaildomain",
    "M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9", "DeviceType", "DeviceInfo", "id_12", "id_13", "id_14",
    "id_15", "id_16", "id_17", "id_18", "id_19", "id_20", "id_21", "id_22", "id_23", "id_24", "id_25", "id_26",
    "id_27", "id_28", "id_29", "id_30", "id_31", "id_32", "id_33", "id_35", "id_37", "id_38",
]

# Columns of the frequency encoding, and those replaced by their own frequency.
FREQUENCY_ENCODED = [
    "card1", "card2", "card3", "card5", "C1", "C2", "C3", "C4", "C5", "C6", "C7", "C8", "C9", "C10", "C11", "C12", "C13",
    "C14", "D1", "D2", "D3", "D4", "D5", "D6", "D7", "D8", "D9", "addr1", "addr2", "dist1", "dist2", "P_emaildomain",
    "R_emaildomain",
]
REPLACED_BY_FREQUENCY = ["card4", "card6", "ProductCD", "M4"]

# Lags in months.
MONTH_LAGS = [0, 1, 2, 3, 6]
SHARE_LAGS = [0, 1, 2, 3, 4, 5, 6]
TARGET_LAGS = [1, 2, 3, 6]
STATISTICS = ["min", "mean", "max", "std"]

# Key columns of the label statistics f218 and f219.
DAY_KEYS = [f"D{i}" for i in range(1, 16)]
ALL_KEYS = [*[f"C{i}" for i in range(1, 15)], *DAY_KEYS, *[f"M{i}" for i in range(1, 10)]]


def joined_table(
    train_transaction: DataFrame, train_identity: DataFrame, test_transaction: DataFrame, test_identity: DataFrame
) -> DataFrame:
    """Transactions of both datasets, each with its identity row where there is one."""
    return with_row_id(
        stack_datasets(left_join(train_transaction, train_identity, KEY), left_join(test_transaction, test_identity, KEY)), KEY
    )


def _narrow(df: DataFrame, *needed: str) -> DataFrame:
    return with_row_id(columns.keep(df, needed, [KEY, DATASET]), KEY)


def _new(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(KEY, DATASET, *names)


def _is_train() -> Column:
    return F.col(DATASET) == "train"


def _clock(df: DataFrame) -> DataFrame:
    """Add the event timestamp, its ``date_block`` (201712) and its month number ``DT_M`` (12 = December 2017)."""
    moment = calendar.offset_timestamp(F.col(SECONDS))
    return df.withColumn("__moment", moment).withColumns({
        "date_block": calendar.month_code(F.col("__moment")), "DT_M": calendar.month_number(F.col("__moment"))
    })


def amount_ratios(df: DataFrame) -> DataFrame:
    """f101: values over the mean and deviation of their card, card kind and address, per dataset (16 columns)."""
    rows = _narrow(df, *RATIO_VALUES, *RATIO_KEYS, *RATIO_EXTRA_KEYS)
    rows = groups.group_ratios(rows, RATIO_VALUES, RATIO_KEYS, [DATASET])
    rows = groups.group_ratios(rows, ["D15"], RATIO_EXTRA_KEYS, [DATASET])
    return _new(rows, [c for c in rows.columns if "_to_mean_" in c or "_to_std_" in c])


def latest_browser(df: DataFrame) -> DataFrame:
    """f102: whether the browser version is a recent one."""
    flag = values.known_value_flag(F.col("id_31"), values.LATEST_BROWSERS)
    return df.select(KEY, DATASET, flag.alias("latest_browser"))


def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]] = tuple(PAIRS)) -> DataFrame:
    """The codes of f103 alone."""
    rows = encoders.pair_codes(_narrow(df, *sorted({c for pair in pairs for c in pair})), pairs)
    return _new(rows, [f"{a}__{b}" for a, b in pairs])


def interactions_and_counts(
    df: DataFrame, useful: Sequence[str] | None = None, pairs: Sequence[tuple[str, str]] = tuple(PAIRS)
) -> DataFrame:
    """f103, and f104 when ``useful`` names the columns that may be counted; ``pairs`` lists the codes that are wanted."""
    full = [c for c in COUNTED_FULL if useful is None or c in useful]
    separate = [c for c in COUNTED_PER_DATASET if useful is None or c in useful]
    paired = sorted({c for pair in pairs for c in pair})
    rows = _narrow(df, "TransactionAmt", SECONDS, "card1", *paired, *full, *separate)
    rows = rows.withColumns({
        "TransactionAmt_decimal": numeric.amount_decimals("TransactionAmt"),
        "Transaction_day_of_week": calendar.offset_weekday(F.col(SECONDS)),
        "Transaction_hour": calendar.offset_hour(F.col(SECONDS)),
    })
    rows = encoders.count_encode(rows, ["card1", *full], suffix="_count_full")
    rows = encoders.count_encode(rows, separate, [DATASET], "_count_dist")
    rows = encoders.pair_codes(rows, pairs)
    return _new(rows, [
        "TransactionAmt_decimal", "card1_count_full", "Transaction_day_of_week", "Transaction_hour",
        *[f"{a}__{b}" for a, b in pairs], *[f"{c}_count_full" for c in full], *[f"{c}_count_dist" for c in separate],
    ])


def count_encodings(df: DataFrame, counted: Sequence[str] = tuple(COUNT_ENCODED)) -> DataFrame:
    """f201: rows with the same value, nulls counted as a value."""
    rows = encoders.count_encode(_narrow(df, *counted), counted, suffix="_CE")
    return _new(rows, [f"{c}_CE" for c in counted])


def time_features(df: DataFrame, measured: Sequence[str]) -> DataFrame:
    """f202: amount digits, card count per dataset, calendar parts, and null and zero shares over ``measured`` columns."""
    rows = _narrow(df, "TransactionAmt", "card1", SECONDS, *measured)
    rows = encoders.count_encode(rows, ["card1"], [DATASET], "_count_full")
    rows = _clock(rows).withColumns({
        "TransactionAmt_decimal": numeric.amount_decimals("TransactionAmt"),
        "Transaction_day_of_week": calendar.offset_weekday(F.col(SECONDS)),
        "Transaction_hour": calendar.offset_hour(F.col(SECONDS)),
        **calendar.parts(F.col("__moment")),
    })
    numbers = [c for c in columns.columns_of(rows, "numeric") if c in measured]
    rows = rows.withColumns({
        "all_group_nan_sum": numeric.null_share(list(measured)), "all_group_0_count": numeric.zero_share(list(measured), numbers)
    })
    return _new(rows, [
        "TransactionAmt_decimal", "card1_count_full", "Transaction_day_of_week", "Transaction_hour", "year", "month", "dow",
        "quarter", "hour", "day", "all_group_nan_sum", "all_group_0_count", "date_block",
    ])


def numeric_lags(df: DataFrame) -> DataFrame:
    """f203: amount and distance statistics of the month and of 1, 2, 3 and 6 listed months before."""
    rows = _with_block_number(_clock(_narrow(df, "TransactionAmt", "dist1", "dist2", SECONDS)))
    rows = lags.period_lags(rows, "date_block", ["TransactionAmt", "dist1", "dist2"], STATISTICS, MONTH_LAGS)
    return _new(rows, ["date_block_num", *[c for c in rows.columns if "__lag" in c]])


def card_count_lags(df: DataFrame) -> DataFrame:
    """f204: rows of the card in the month and in months before it."""
    rows = _with_block_number(_clock(_narrow(df, "card1", SECONDS)))
    rows = lags.key_lags(rows, "card1", "date_block_num", MONTH_LAGS)
    return _new(rows, [f"card1_counts__lag{n}" for n in MONTH_LAGS])


def _with_block_number(rows: DataFrame) -> DataFrame:
    """Number the months that occur, from 0 in time order."""
    return encoders.number_values(rows, "date_block", "date_block_num")


def record_counts(df: DataFrame) -> DataFrame:
    """f205: rows of the dataset in the same month and on the same day."""
    rows = _clock(_narrow(df, SECONDS)).withColumn("__day", calendar.day_code(F.col("__moment")))
    rows = groups.group_row_counts(rows, [DATASET, "date_block"], "motnthly_count")
    rows = groups.group_row_counts(rows, [DATASET, "__day"], "daily_count")
    return _new(rows, ["motnthly_count", "daily_count"])


def share_lags(df: DataFrame, column: str = "card1") -> DataFrame:
    """f206 and f208 to f215: share of the column's value in the month and in the six months before."""
    rows = lags.key_lags(_clock(_narrow(df, column, SECONDS)), column, "DT_M", SHARE_LAGS, share=True)
    return _new(rows, [f"{column}_counts__lag{n}" for n in SHARE_LAGS])


def pseudo_label_lags(df: DataFrame, scores: DataFrame) -> DataFrame:
    """f207: mean score per month; lag n looks n rows up from the month before. ``scores`` holds key and ``pseudo_label``."""
    rows = left_join(_clock(_narrow(df, SECONDS)), scores.select(KEY, "pseudo_label"), KEY)
    rows = lags.period_lags(rows, "DT_M", ["pseudo_label"], ["mean"], MONTH_LAGS, extra=1)
    names = {f"pseudo_label_mean__lag{n}": f"pseudo_label__lag{n}" for n in MONTH_LAGS}
    return _new(rows.withColumnsRenamed(names), list(names.values()))


def train_lags(df: DataFrame, column: str = "D9") -> DataFrame:
    """f216: monthly statistics learnt from train rows only; months beyond the train table get null."""
    rows = lags.period_lags(_clock(_narrow(df, column, SECONDS)), "DT_M", [column], STATISTICS, MONTH_LAGS, fit=_is_train())
    return _new(rows, [f"{column}_{s}__lag{n}" for n in MONTH_LAGS for s in STATISTICS])


def target_lags(df: DataFrame, keys: Sequence[str] = ("D9",), include_label: bool = False) -> DataFrame:
    """f217 to f219: label statistics of the same key values in earlier train months, as floats."""
    rows = lags.target_lags(
        _clock(_narrow(df, *keys, LABEL, SECONDS)), "DT_M", list(keys), LABEL, TARGET_LAGS, fit=_is_train(), include_label=include_label
    )
    names = [f"{LABEL}_{s}__lag{n}" for n in TARGET_LAGS for s in ("mean", "std")]
    return rows.select(KEY, DATASET, *[F.col(c).cast("float").alias(c) for c in names])


def split_identity(identity: DataFrame, rare_below: int = 200) -> DataFrame:
    """Device, system, browser and screen parts of identity texts, and the flag that an identity row exists."""
    wide = identity.withColumns({
        "device_name": text.classify(text.part(F.col("DeviceInfo"), "/", 0), text.DEVICE_RULES),
        "device_version": text.part(F.col("DeviceInfo"), "/", 1),
        "OS_id_30": text.part(F.col("id_30"), " ", 0), "version_id_30": text.part(F.col("id_30"), " ", 1),
        "browser_id_31": text.part(F.col("id_31"), " ", 0), "version_id_31": text.part(F.col("id_31"), " ", 1),
        "screen_width": text.part(F.col("id_33"), "x", 0), "screen_height": text.part(F.col("id_33"), "x", 1),
        "id_34": text.part(F.col("id_34"), ":", 1), "id_23": text.part(F.col("id_23"), ":", 1),
        "had_id": F.lit(1),
    })
    return encoders.bucket_rare(with_row_id(wide, KEY), "device_name", rare_below)


def prepared_table(
    train_transaction: DataFrame, train_identity: DataFrame, test_transaction: DataFrame, test_identity: DataFrame,
    useful: Sequence[str] | None = None,
) -> DataFrame:
    """One model-ready table: identity parts, ratios, log, calendar, codes, counts, mail groups; all text as codes.

    ``useful`` lists the raw and identity columns to keep; all are kept without it.
    """
    rows = joined_table(train_transaction, split_identity(train_identity), test_transaction, split_identity(test_identity))
    if useful is not None:
        rows = columns.keep(rows, useful, [KEY, DATASET, LABEL, SECONDS])
    rows = groups.group_ratios(rows, RATIO_VALUES, ["card1", "card4", "addr1"], [DATASET])
    rows = rows.withColumns({
        "TransactionAmt_Log": numeric.natural_log("TransactionAmt"),
        "TransactionAmt_decimal": numeric.amount_decimals("TransactionAmt"),
        "Transaction_day_of_week": calendar.offset_weekday(F.col(SECONDS)),
        "Transaction_hour": calendar.offset_hour(F.col(SECONDS)),
    })
    rows = encoders.pair_codes(rows, PAIRS)
    rows = encoders.count_encode(rows, ["card1", "card2", "card3", "card4", "card5", "card6", "id_36"], suffix="_count_full")
    rows = encoders.count_encode(rows, ["id_01", "id_31", "id_33", "id_36"], [DATASET], "_count_dist")
    for mail in ("P_emaildomain", "R_emaildomain"):
        rows = encoders.group_map(rows, mail, values.EMAIL_PROVIDERS, f"{mail}_bin")
        rows = rows.withColumn(f"{mail}_suffix", text.suffix_group(F.col(mail)))
    return columns.narrow_types(encode_text(rows, missing="nan"))


def encode_text(df: DataFrame, missing: str, skip: Sequence[str] = ()) -> DataFrame:
    """Replace every text column but the dataset and those in ``skip`` by its code over both datasets."""
    texts = [c for c in columns.columns_of(df, "text") if c not in (DATASET, *skip)]
    coded = encoders.label_encode(df, texts, suffix="__code", missing=missing)
    return coded.drop(*texts).withColumnsRenamed({f"{c}__code": c for c in texts})


def encoded_table(df: DataFrame) -> DataFrame:
    """Flags and levels as numbers, rare cards removed, frequency and target-mean columns, remaining text as codes."""
    # Joins come last: the passes that count values read what stands before them.
    rows = encoders.count_encode(df, REPLACED_BY_FREQUENCY, suffix="__n", nulls=False)
    rows = rows.drop(*REPLACED_BY_FREQUENCY).withColumnsRenamed({f"{c}__n": c for c in REPLACED_BY_FREQUENCY})
    # Which columns hold which kind of level.
    levels = {
        **dict.fromkeys(["M1", "M2", "M3", "M5", "M6", "M7", "M8", "M9", "id_35", "id_36", "id_37", "id_38"], values.TRUE_FALSE),
        **dict.fromkeys(["id_12", "id_16", "id_27", "id_29"], values.FOUND),
        "id_15": values.NEW_FOUND_UNKNOWN, "id_28": values.NEW_FOUND, "id_23": values.PROXY, "DeviceType": values.DEVICE_TYPE,
    }
    width, height = text.screen_size(F.col("id_33"))
    rows = rows.withColumns({
        **{c: values.constant_map(F.col(c), levels[c]) for c in levels},
        "id_34": text.trailing_number(F.col("id_34")), "id_33_0": width, "id_33_1": height,
        "id_33": F.coalesce(F.nullif(F.col("id_33"), F.lit("0x0")), F.lit("unseen_before_label")),
    })
    texts = [c for c in columns.columns_of(rows, "text") if c != DATASET]
    rows = encoders.count_encode(rows, [c for c in FREQUENCY_ENCODED if c != "card1"], suffix="__fq_enc", nulls=False)
    rows = encode_text(rows, missing="__NA__", skip=["card1"])
    # The frequency stands for the value here, so values with equal frequencies share one target mean.
    meant = ["ProductCD", "M4"]
    rows = encoders.target_mean_encode(rows, meant, LABEL, _is_train())
    rows = encoders.null_rare(with_row_id(rows, KEY), "card1", _is_train(), above=10, count="card1__fq_enc")
    rows = encode_text(rows, missing="__NA__")  # cards that are texts
    rows = rows.withColumnsRenamed({
        **{f"{c}__target_mean": f"f000__{c}__target_mean" for c in meant}, **{f"{c}__fq_enc": f"f000__{c}__fq_enc" for c in FREQUENCY_ENCODED},
    })
    return rows.select(
        *[c for c in df.columns if c not in REPLACED_BY_FREQUENCY and c not in texts], *REPLACED_BY_FREQUENCY,
        *[f"f000__{c}__target_mean" for c in meant], "id_33_0", "id_33_1", *[f"f000__{c}__fq_enc" for c in FREQUENCY_ENCODED], *texts,
    )
