"""The small customer feed: contract, two batches, and the history they must lead to."""

CONTRACT_SCHEMA = (
    "fp_id bigint, col_name string, col_datatype string, col_ordinal int, primary_key_pos int, "
    "is_defining_col string, is_audit_col string"
)
CONTRACT = [
    (1, "customerId", "IntegerType", 0, 0, "N", "Y"),
    (1, "address", "StringType", 1, 0, "N", "N"),
    (1, "city", "StringType", 2, 0, "N", "N"),
    (1, "createdOn", "TimestampType", 3, 0, "Y", "Y"),
]
FEEDS_SCHEMA = "fp_id bigint, file_format string, target_table_partition string"

BATCH_SCHEMA = "customerId string, address string, city string, createdOn string"
FULL_LOAD = [
    ("3", "current address for 3", "chapel hil", "2020-01-01 4:26"),
    ("2", "current address for 2", "cary", "2020-01-01 7:34"),
    ("1", "old address for 1", "durham", "2020-01-01 2:34"),
    ("1", "current address for 1", "durham", "2020-01-02 2:27"),
]
INCREMENT = [
    ("4", "new address for 4", "Raleigh", "2018-04-04 4:49"),
    ("3", "current address for 3 update", "apex", "2018-04-04 9:32"),
    ("1", "new address for 1", "durham", "2018-03-03 2:35"),
]

# (customerId, startDate, endDate, first 8 characters of hashData)
AFTER_FULL_LOAD = {
    ("1", "2020-01-01 2:34", "2020-01-02 2:27", "1b8c9703"),
    ("1", "2020-01-02 2:27", None, "46dbc169"),
    ("2", "2020-01-01 7:34", None, "fa1e24b2"),
    ("3", "2020-01-01 4:26", None, "0e6be272"),
}
AFTER_INCREMENT = {
    ("1", "2020-01-01 2:34", "2020-01-02 2:27", "1b8c9703"),
    ("1", "2020-01-02 2:27", "2018-03-03 2:35", "46dbc169"),
    ("1", "2018-03-03 2:35", None, "99b862ad"),
    ("2", "2020-01-01 7:34", None, "fa1e24b2"),
    ("3", "2020-01-01 4:26", "2018-04-04 9:32", "0e6be272"),
    ("3", "2018-04-04 9:32", None, "a25d8362"),
    ("4", "2018-04-04 4:49", None, "8662a510"),
}
KEY_HASHES = {"1": "6b86b273", "2": "d4735e3a", "3": "4e074085", "4": "4b227777"}


def summary(history):
    rows = history.select("customerId", "startDate", "endDate", "hashData").collect()
    return sorted(
        ((r[0], r[1], r[2], r[3][:8]) for r in rows), key=lambda row: tuple(map(str, row))
    )


def expected(rows):
    return sorted(rows, key=lambda row: tuple(map(str, row)))
