"""Inputs and outputs: bronze ingest with declared schemas, the catalog
namespace, and the mapping of the driver's test tables onto the model."""
