from .delimited import export_csv, read_delimited, read_fragment  # noqa: F401
from .tables import (append_rows, create_from_contract, ensure_namespace, materialize,  # noqa: F401
                     rebuild, write_clustered, write_distributed_randomly)
