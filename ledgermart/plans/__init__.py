"""End-to-end flows over a lake of partitioned stores."""
