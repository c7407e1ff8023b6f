"""permitry: business-licence analytics as Spark DataFrame operators."""

from permitry.session import ship

__version__ = "0.1.0"

ship()
