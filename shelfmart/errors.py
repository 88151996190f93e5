"""One error family for contract, reconciliation and quality failures."""


class PipelineError(RuntimeError):
    """Base class for expected pipeline failures."""


class ContractError(PipelineError, ValueError):
    """The source extract does not satisfy the schema contract."""


class SourceChangedError(PipelineError):
    """The source files changed while they were being read."""


class ReconciliationError(PipelineError):
    """Two layers that must agree do not."""


class KeyIntegrityError(PipelineError):
    """A primary or foreign key constraint is violated."""


class DataQualityError(PipelineError):
    """Quality rules failed under the STOP policy."""
