"""Arrow functions in Python whose memory does not grow with the rows of a batch."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# Rows that are Python objects at a time; Spark bounds a batch itself by its bytes.
SLICE = 32
# Bytes of results that wait in the worker; more are handed on before the batch ends.
OUT_BYTES = 1 << 20


def in_slices(function, kind, rows=SLICE):
    """Arrow function of one column: `function` maps a list of values to a list of values of the type `kind`.

    Only `rows` rows of a batch are Python objects at a time; the others stay in Arrow's buffers.
    Results leave the worker in batches of about OUT_BYTES, so that it never holds those of a
    whole batch, and once more while they are put together.
    """
    shape = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            parts, held = [], 0
            for at in range(0, len(values), rows):
                parts.append(pa.array(function(values.slice(at, rows).to_pylist()), shape))
                held += parts[-1].nbytes
                if held >= OUT_BYTES:
                    yield pa.concat_arrays(parts)
                    parts, held = [], 0
            if parts:
                yield pa.concat_arrays(parts)

    return run
