"""Every query by name. Importing the modules fills the registry."""

from tillcast.plans import bulk, coupon, day_split, features, model, promo, sales, scalars, scope, streams  # noqa: F401
from tillcast.plans.registry import QUERIES, SQL  # noqa: F401
