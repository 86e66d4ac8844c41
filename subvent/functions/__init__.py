from subvent.functions.activation import recu, recu_slope
from subvent.functions.checks import complete, require

__all__ = ["complete", "recu", "recu_slope", "require"]
