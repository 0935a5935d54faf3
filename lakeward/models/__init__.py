"""The warehouse's SQL models re-expressed as DataFrame functions.

``MODELS`` maps each model name to its function; ``ModelContext`` carries
staging tables, prebuilt models and variables; ``build`` returns lazy
DataFrames and ``materialize`` writes them layer by layer.

"""

from lakeward.models import flow, gold, resources, silver_dims, silver_facts, silver_hierarchy  # noqa: F401
from lakeward.models.base import MODELS, MissingInput, ModelContext, build, materialize, model

__all__ = ["MODELS", "MissingInput", "ModelContext", "build", "materialize", "model"]
