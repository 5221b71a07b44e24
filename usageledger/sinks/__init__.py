"""Writers and partition maintenance."""
