"""Error types raised by the data checks."""


class RatecraftError(Exception):
    """Base class for all errors raised by this package."""


class DuplicateKeyError(RatecraftError):
    """The right side of a many-to-one join repeats a key."""


class MissingColumnsError(RatecraftError):
    """Required columns are absent from a frame."""


class EmptyFrameError(RatecraftError):
    """A frame that must hold rows holds none."""


class ValidationError(RatecraftError):
    """A frame or a configuration breaks a stated rule."""


class AssetLoadError(RatecraftError):
    """A saved model or parameter table could not be found or read."""


class UnknownCategoryError(RatecraftError):
    """A strict encoder met a level it was not fitted on."""


class CheckpointFolderError(RatecraftError):
    """A cluster session names no shared folder for checkpoints."""
