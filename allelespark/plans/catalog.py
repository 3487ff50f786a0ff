"""All registered queries."""
from allelespark.plans import q_clean  # noqa: F401
from allelespark.plans.registry import ORACLES, QUERIES  # noqa: F401
from allelespark.plans import q_filters  # noqa: F401
from allelespark.plans import q_joins  # noqa: F401
from allelespark.plans import q_qc, q_summary  # noqa: F401
from allelespark.plans import q_window  # noqa: F401
from allelespark.plans import q_norm  # noqa: F401
from allelespark.plans import q_assoc  # noqa: F401
from allelespark.plans import q_io  # noqa: F401
