"""Column expressions: pure ``Column -> Column`` helpers, all JVM-side built-ins."""

from flightlake.functions.columns import (  # noqa: F401
    epoch_to_text,
    flight_phase_expr,
    planar_distance,
    proximity_status_expr,
    safe_cast,
    state_field,
)
from flightlake.functions.dates import calendar_columns  # noqa: F401
