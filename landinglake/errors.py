"""The few errors a caller may want to tell apart."""


class LandingLakeError(Exception):
    """Base of every error raised by this package."""


class AllRecordsRejected(LandingLakeError):
    """Every record of an entity was malformed."""


class NameCollision(LandingLakeError):
    """Two source columns get the same clean name."""


class LocationMismatch(LandingLakeError):
    """A table exists already, at another location than the one asked for."""


class SnapshotTaken(LandingLakeError):
    """Another writer has written the next version of a snapshot table first."""


class StepFailed(LandingLakeError):
    """A layer refresh reported a failed step."""
