"""wardledger: clinical record cleaning, FHIR flattening and compliance audit on Spark."""

__version__ = "0.1.0"
