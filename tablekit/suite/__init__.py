from tablekit.suite import families, intervals, loading, quality, scans, streams, windows  # noqa: F401
from tablekit.suite.registry import CASES  # noqa: F401
