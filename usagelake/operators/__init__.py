from usagelake.operators import app, device, model, population, sampling, user  # noqa: F401
from usagelake.operators.model import Usage

__all__ = ["Usage", "app", "device", "model", "population", "sampling", "user"]
