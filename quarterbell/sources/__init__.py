from quarterbell.sources.messages import kafka_options, read_groups, read_messages, spark_consumer_options

__all__ = ["kafka_options", "read_groups", "read_messages", "spark_consumer_options"]
