from .lakehouse import Lakehouse
