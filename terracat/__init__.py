"""terracat: catalog, vocabulary, integrity and staging jobs for
place-related datasets, written as Spark DataFrame transformations.

Entry points::

    from terracat import get_session, load_catalog, load_vocabulary_files, check_loaded
"""

from .contracts import CONTRACTS, contract  # noqa: F401
from .operators.ids import dense_id  # noqa: F401
from .plans.catalog import build_attr_index, build_geom_index, refresh_attr_index, refresh_geom_index  # noqa: F401
from .plans.integrity import check_tables  # noqa: F401
from .plans.load import check_loaded, load_catalog, load_vocabulary_files  # noqa: F401
from .plans.staging import decode_concepts, read_indexed, stage_attributes, stage_geometries  # noqa: F401
from .plans.vocabulary import complete_reverse, load_vocabulary  # noqa: F401
from .session import get_session  # noqa: F401
from .sources.delimited import export_csv, read_delimited  # noqa: F401

__version__ = "0.1.0"
