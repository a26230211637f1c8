"""Declared schemas of rules, state, history and sinks."""

from pyspark.sql import types as T


def _struct(**columns):
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TS, _NTZ = T.TimestampType(), T.TimestampNTZType()

RULE = _struct(log_source=_S, pos=_I, target=_S, source=_S)
REGISTRY = _struct(source_name=_S, parser_xml=_S, updated_at=_NTZ)
CURSOR = _struct(source_name=_S, watermark_value=_S, watermark_type=_S, updated_at=_NTZ)
# A file as a load has read it: up to where, the how manieth of its name, its first bytes' digest.
FILES = _struct(path=_S, length=_L, modified=_L, position=_L, generation=_I, head_bytes=_I, head=_S)
# What of a file a load is to read, and the file as it then is.
READS = _struct(
    path=_S, length=_L, modified=_L, start=_L, upto=_L, position=_L, generation=_I, head_bytes=_I, head=_S
)
HISTORY = _struct(
    id=_S,
    source_name=_S,
    target_index=_S,
    processed_count=_L,
    failed_count=_L,
    late_count=_L,
    blank_count=_L,
    status=_S,
    error_message=_S,
    start_time=_NTZ,
    collect_time=_NTZ,
)

# The people's names of the moment, and the names and rules that a load has used.
PEOPLE = _struct(name=_S, folder=_S)
SIDES = _struct(people=_S, rules=T.ArrayType(_struct(target=_S, source=_S)))
# What a user did on a day, as sketches that add up.
PROFILE = _struct(user_id=_S, event_date=T.DateType(), n=_L, kinds=T.BinaryType(), amounts=T.BinaryType(), top=_D)

# The stored alert: fixed columns of every source, everything else in `extras`.
ALERT_DOC = _struct(
    row_id=_S,
    final_ts=_NTZ,
    timestamp=_S,
    time_inferred=T.BooleanType(),
    user_id=_S,
    user=_S,
    department=_S,
    action=_S,
    src_ip=_S,
    emp_name=_S,
    duration=_D,
    src_port=_D,
    dst_port=_D,
    packets_total=_D,
    bytes_total=_D,
    raw_message=_S,
    risk_score=_D,
    alert_message=_S,
    extras=T.MapType(_S, _S),
    error_reason=_S,
    load_status=_S,
    event_date=T.DateType(),
)

# Columns of the relational alert table, in order.
ALERT_TABLE = _struct(
    final_ts=_NTZ,
    log_source=_S,
    user_id=_S,
    department=_S,
    src_ip=_S,
    action=_S,
    risk_score=_D,
    alert_message=_S,
    salary=_D,
    bytes_total=_L,
    packets_total=_L,
    machine_name=_S,
    fw_rule_id=_S,
    src_port=_I,
    dst_ip=_S,
    dst_port=_I,
    protocol=_S,
    app_name=_S,
    duration=_I,
    end_time=_S,
    timestamp=_S,
    hire_date=_S,
    email=_S,
    emp_id=_S,
    emp_name=_S,
    job_title=_S,
    phone=_S,
    rank_name=_S,
    ssn=_S,
    static_ip=_S,
    created_at=_NTZ,
)
# Personal data: only written when asked for, never part of a fingerprint.
PERSONAL_COLUMNS = ["salary", "hire_date", "email", "job_title", "phone", "rank_name", "ssn"]


def alert_table(personal: bool = False) -> T.StructType:
    """The relational alert table; personal columns are opt-in."""
    return T.StructType([f for f in ALERT_TABLE if personal or f.name not in PERSONAL_COLUMNS])
