"""dBase (.dbf) capture files as a Spark data source.

``spark.read.format("dbf").option("path", folder).option("family", "site").load()``

* Files: every ``*.dbf`` in the folder; the table name is the text between ``+`` and
  ``.dbf``; ``family`` (a regex) keeps the tables whose name matches it.
* Schema: union of the fields of the matching files (headers only, read on the driver);
  a field missing from a file is NULL there (``bind_rows``).
* Partitions: one per file and record range (``recordsPerPartition``): records are
  fixed width, so a range starts at ``header_len + start * record_len`` and no split
  can cut a record. Files with no records add no partition (empty tables drop out).
* Decoding: each partition reads its byte range once, in blocks of ``BLOCK`` bytes (what a
  task holds does not grow with the file), and decodes whole columns of a block with numpy
  into an Arrow batch; no per-row Python.

Types: C -> string (trailing blanks trimmed; an all-blank value is NULL), N without
decimals -> int (width <= 9) / long (<= 18) / double, N with decimals and F -> double
(blank or ``*`` is NULL), D -> date, L -> boolean (``?`` is NULL). Deleted records
(flag ``*``) are skipped.
"""

from __future__ import annotations

import datetime as _dt
import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

#: Bytes of records decoded at a time; decoded text takes some 20 times as much memory.
BLOCK = 2 << 20

_NAME = re.compile(r"\+(.*)\.dbf$", re.IGNORECASE)


def local_path(uri: str) -> str:
    """POSIX path of a ``file:`` URI or plain path; the Python reader/writer need one
    (on a cluster: a shared mount visible to every executor)."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", uri):
        raise ValueError(f"dbf files need a mounted path, got {uri}")
    return uri


def table_of(path: str) -> str | None:
    m = _NAME.search(os.path.basename(path))
    return m.group(1) if m else None


def read_header(path: str):
    """(n_records, header_len, record_len, [(name, type, length, decimals, offset)])."""
    with open(path, "rb") as fh:
        head = fh.read(32)
        n, hlen, rlen = struct.unpack("<IHH", head[4:12])
        raw = fh.read(hlen - 32)
    fields, off = [], 1
    for i in range(0, len(raw) - 1, 32):
        d = raw[i:i + 32]
        if d[0] == 0x0D:
            break
        name = d[:11].split(b"\x00", 1)[0].decode("ascii", "replace").strip()
        ftype = chr(d[11])
        length, dec = d[16], d[17]
        fields.append((name, ftype, length, dec, off))
        off += length
    return n, hlen, rlen, fields


def _spark_type(ftype: str, length: int, dec: int):
    if ftype in ("N", "F"):
        if ftype == "N" and dec == 0:
            if length <= 9:
                return IntegerType()
            if length <= 18:
                return LongType()
        return DoubleType()
    if ftype == "D":
        return DateType()
    if ftype == "L":
        return BooleanType()
    return StringType()


def _merge(a, b):
    if a == b:
        return a
    nums = (IntegerType(), LongType(), DoubleType())
    if a in nums and b in nums:
        return DoubleType() if DoubleType() in (a, b) else LongType()
    return StringType()


def _list_files(path: str, family: str | None):
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.lower().endswith(".dbf"))
    if family:
        pat = re.compile(family)
        files = [f for f in files if table_of(f) is not None and pat.search(table_of(f))]
    return files


class DbfPartition(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        super().__init__((path, start, stop))
        self.path, self.start, self.stop = path, start, stop


class DbfDataSource(DataSource):
    """Read-only data source for folders of dBase III files."""

    @classmethod
    def name(cls):
        return "dbf"

    def _files(self):
        return _list_files(local_path(self.options["path"]), self.options.get("family"))

    def schema(self):
        types: dict[str, object] = {}
        for f in self._files():
            for name, ftype, length, dec, _ in read_header(f)[3]:
                t = _spark_type(ftype, length, dec)
                types[name] = _merge(types[name], t) if name in types else t
        fields = [StructField(n, t, True) for n, t in types.items()]
        if self.options.get("includeTable", "false").lower() == "true":
            fields.append(StructField("_table", StringType(), True))
        return StructType(fields)

    def reader(self, schema):
        return DbfReader(self.options, schema, self._files())


class DbfReader(DataSourceReader):
    def __init__(self, options, schema, files):
        self.schema = schema
        self.files = files
        self.per_part = int(options.get("recordsPerPartition", 1_000_000))
        self.encoding = options.get("encoding", "latin-1")

    def partitions(self):
        parts = []
        for f in self.files:
            n = read_header(f)[0]
            for s in range(0, n, self.per_part):
                parts.append(DbfPartition(f, s, min(n, s + self.per_part)))
        return parts or [DbfPartition("", 0, 0)]

    def read(self, partition):
        if not partition.path or partition.stop <= partition.start:
            return
        _, hlen, rlen, fields = read_header(partition.path)
        by_name = {f[0]: f for f in fields}
        step = max(1, BLOCK // rlen)
        with open(partition.path, "rb") as fh:
            fh.seek(hlen + partition.start * rlen)
            for at in range(partition.start, partition.stop, step):
                block = fh.read(min(step, partition.stop - at) * rlen)
                yield self._batch(block, rlen, by_name, partition.path)

    def _batch(self, block: bytes, rlen: int, by_name: dict, path: str):
        count = len(block) // rlen
        buf = np.frombuffer(block[:count * rlen], dtype=np.uint8).reshape(count, rlen)
        buf = buf[buf[:, 0] != 0x2A]
        arrays = []
        for fld in self.schema.fields:
            if fld.name == "_table":
                arrays.append(pa.array([table_of(path)] * len(buf), pa.string()))
                continue
            spec = by_name.get(fld.name)
            if spec is None:
                arrays.append(pa.nulls(len(buf), _arrow_type(fld.dataType)))
                continue
            _, ftype, length, dec, off = spec
            raw = np.ascontiguousarray(buf[:, off:off + length]).view(f"S{length}").ravel()
            arrays.append(_decode(raw, ftype, fld.dataType, self.encoding))
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in self.schema.fields])


def _arrow_type(t):
    return {IntegerType(): pa.int32(), LongType(): pa.int64(), DoubleType(): pa.float64(),
            DateType(): pa.date32(), BooleanType(): pa.bool_()}.get(t, pa.string())


def _decode(raw: np.ndarray, ftype: str, dtype, encoding: str):
    text = np.char.strip(np.char.decode(raw, encoding))
    blank = (text == "") | (text == "*" * 1) | np.char.startswith(text, "*")
    if isinstance(dtype, StringType):
        vals = text.astype(object)
        vals[text == ""] = None
        return pa.array(vals, pa.string())
    if isinstance(dtype, (IntegerType, LongType, DoubleType)):
        safe = np.where(blank, "0", text)
        if not isinstance(dtype, DoubleType):
            whole = pc.match_substring_regex(pa.array(safe.astype(object), pa.string()), r"^[+-]?[0-9]{1,18}$")
            if pc.all(whole).as_py() is not False:  # straight to integers, never through a double
                ints = pc.cast(pa.array(np.char.lstrip(safe, "+").astype(object), pa.string()), pa.int64())
                return pc.if_else(pa.array(blank), pa.scalar(None, pa.int64()), ints).cast(_arrow_type(dtype))
        try:
            nums = safe.astype(np.float64)
        except ValueError:
            nums = np.array([_to_float(x) for x in safe], dtype=np.float64)
            blank = blank | np.isnan(nums)
        mask = blank
        if isinstance(dtype, DoubleType):
            return pa.array(nums, pa.float64(), mask=mask)
        return pa.array(nums.astype(np.int64), _arrow_type(dtype), mask=mask)
    if isinstance(dtype, DateType):
        import pandas as pd
        days = pd.to_datetime(pd.Series(text.astype(object)), format="%Y%m%d", errors="coerce")
        return pa.array(days.to_numpy().astype("datetime64[D]"), pa.date32())
    if isinstance(dtype, BooleanType):
        up = np.char.upper(text)
        vals = np.where(np.isin(up, ["T", "Y"]), True, False)
        mask = ~np.isin(up, ["T", "Y", "F", "N"])
        return pa.array(vals, pa.bool_(), mask=mask)
    return pa.array(text.astype(object), pa.string())


def _to_float(x: str) -> float:
    try:
        return float(x)
    except ValueError:
        return float("nan")


# ---------------------------------------------------------------- writing


def _field_spec(name: str, dtype, width: int | None):
    from pyspark.sql import types as T
    if len(name) > 10:
        raise ValueError(f"dBase field names have 10 characters at most: {name}")
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)) and (width or 1) > 18:
        raise ValueError(f"{name}: integers of {width} characters do not fit a dBase field")
    if isinstance(dtype, T.StringType) and (width or 1) > 254:
        raise ValueError(f"{name}: text of {width} characters does not fit a dBase field")
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return (name, "N", max(1, min(18, width or 11)), 0)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return (name, "N", 24, 10)
    if isinstance(dtype, T.DateType):
        return (name, "D", 8, 0)
    if isinstance(dtype, T.BooleanType):
        return (name, "L", 1, 0)
    return (name, "C", max(1, min(254, width or 1)), 0)


def _encode_batch(pdf, specs, encoding: str) -> bytes:
    """Fixed-width records of one pandas batch, formatted column by column."""
    import pandas as pd
    n = len(pdf)
    rlen = 1 + sum(s[2] for s in specs)
    out = np.full((n, rlen), 0x20, dtype=np.uint8)  # deletion flag ' ' and blank fields
    if n == 0:
        return out.tobytes()
    off = 1
    for name, ftype, length, dec in specs:
        col = pdf[name]
        null = col.isna().to_numpy()
        if ftype == "N":
            if dec:
                num = pd.to_numeric(col).fillna(0).to_numpy(dtype="float64")
                txt = np.char.mod(f"%.{dec}f", num)
                txt = np.where(txt.astype("float64") == num, txt, num.astype(str))  # else every digit it has
                if ((np.char.str_len(txt) > length) | (np.char.find(txt, "e") >= 0) | ~np.isfinite(num)).any():
                    raise ValueError(f"{name}: a number does not fit {length} characters")
            else:
                txt = col.astype(str).to_numpy()  # integers arrive as text
            txt = np.char.rjust(np.where(null, "", txt).astype(str), length)
        elif ftype == "D":
            txt = pd.to_datetime(col).dt.strftime("%Y%m%d").fillna("").to_numpy().astype(str)
        elif ftype == "L":
            txt = np.where(null, "?", np.where(col.fillna(False).astype(bool).to_numpy(), "T", "F"))
        else:
            txt = np.where(null, "", col.astype(str).to_numpy()).astype(str)
        code = np.char.encode(txt.astype(str), encoding)  # a character outside the code page is an error
        if (np.char.str_len(code) > length).any():
            raise ValueError(f"{name}: a value is longer than {length} bytes")
        raw = code.astype(f"S{length}")
        block = np.frombuffer(raw.tobytes(), dtype=np.uint8).reshape(n, length).copy()
        block[block == 0] = 0x20  # fixed-width text is blank-padded, not NUL-padded
        out[:, off:off + length] = block
        off += length
    return out.tobytes()


def _header(n: int, specs) -> bytes:
    hlen = 32 + 32 * len(specs) + 1
    rlen = 1 + sum(s[2] for s in specs)
    today = _dt.date.today()
    h = struct.pack("<BBBBIHH20x", 0x03, today.year - 1900, today.month, today.day, n, hlen, rlen)
    for name, ftype, length, dec in specs:
        h += struct.pack("<11sc4xBB14x", name.encode("ascii")[:10], ftype.encode("ascii"), length, dec)
    return h + b"\x0D"


def write_dbf(df, folder: str, table: str, prefix: str = "part", encoding: str = "latin-1") -> str:
    """Write ``df`` as dBase III files ``<prefix>-<task>+<table>.dbf``, one per partition.

    Field widths come from one aggregate pass (one number per column reaches the
    driver). The tasks write straight to ``folder``, which must be a path every
    executor can write (a shared mount); returns the folder.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    folder = local_path(folder)
    os.makedirs(folder, exist_ok=True)
    widths_row = df.agg(*[
        (F.max(F.length(F.col(f.name))) if isinstance(f.dataType, T.StringType)
         else F.max(F.length(F.col(f.name).cast("long").cast("string"))) if isinstance(
            f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)) else F.lit(None)).alias(f.name)
        for f in df.schema.fields]).first()
    specs = [_field_spec(f.name, f.dataType, widths_row[f.name]) for f in df.schema.fields]

    def write_part(batches):
        import pandas as pd
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId()
        path = os.path.join(folder, f"{prefix}-{pid:05d}+{table}.dbf")
        # each attempt writes its own file and renames it into place at the end, so a
        # retried or speculative attempt never interleaves with another (last one wins)
        tmp = f"{path}.{ctx.taskAttemptId()}.tmp"
        total = 0
        with open(tmp, "w+b") as fh:
            fh.write(_header(0, specs))
            for pdf in batches:  # streamed batch by batch; the count is patched at the end
                fh.write(_encode_batch(pdf, specs, encoding))
                total += len(pdf)
            fh.write(b"\x1A")
            fh.seek(4)
            fh.write(struct.pack("<I", total))
        os.replace(tmp, path)
        yield pd.DataFrame({"path": [path], "rows": [total]})

    whole = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
    # integers go as text: a pandas column holding NULLs would turn them into doubles
    df = df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, whole) else F.col(f.name)
                     for f in df.schema.fields])
    df.mapInPandas(write_part, "path string, rows long").collect()
    return folder


def register(spark) -> None:
    spark.dataSource.register(DbfDataSource)


def read_dbf(spark, folder: str, family: str | None = None, lower: bool = True, records_per_partition: int = 1_000_000):
    """Scan a folder of capture files (optionally one table family), names lower-cased."""
    register(spark)
    r = spark.read.format("dbf").option("path", folder).option("recordsPerPartition", records_per_partition)
    if family:
        r = r.option("family", family)
    df = r.load()
    return df.toDF(*[c.lower() for c in df.columns]) if lower else df
