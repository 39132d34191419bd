"""Parameter checks; a bad value stops the call before any job is planned."""


def positive(**params):
    for name, value in params.items():
        if value is None or value <= 0:
            raise ValueError(f"{name} must be positive, got {value}")


def non_negative(**params):
    for name, value in params.items():
        if value is None or value < 0:
            raise ValueError(f"{name} must not be negative, got {value}")


def rate(**params):
    for name, value in params.items():
        if value is None or not 0 <= value <= 1:
            raise ValueError(f"{name} must lie between 0 and 1, got {value}")


def ordered(low_name, low, high_name, high):
    if low > high:
        raise ValueError(f"{low_name} must not exceed {high_name}, got {low} > {high}")


def one_of(name, value, allowed):
    if value not in allowed:
        raise ValueError(f"{name} must be one of {sorted(allowed)}, got {value!r}")
