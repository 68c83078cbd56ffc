from regmine.sources.io import read_registry, read_registry_text, write_products, read_product  # noqa: F401
from regmine.sources.registry import registry_view, load_table  # noqa: F401
